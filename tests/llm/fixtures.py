"""Small tables with what the operators must cope with."""

from __future__ import annotations

import random

WORDS = "the of and river stone lantern window seven morning garden quiet copper engine letter mountain harbour silver thread winter paper".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", "ing", "er", ","]) for _ in range(n))


def lines(seed: int, n: int) -> str:
    return "\n".join(prose(seed * 1000 + i, 12) + "." for i in range(n))


def texts() -> list[str | None]:
    """Null, empty and blank texts, ties, copies, near copies, shared passages, one very long text and odd characters."""
    base = lines(1, 14)
    near = base.replace("river", "rivers", 1)
    shared = lines(99, 8)
    out = [None, "", " \n\t ", "one", "two words", base, base, near, base + "\n" + prose(5, 20), shared + "\n" + lines(2, 6),
           lines(3, 4) + "\n" + shared, "a" * 1500, ("abc " * 300), lines(4, 400), "é" * 500 + " ünï cödé \U0001f600 x" * 30,
           "x\x0by\x0cz\r\n" * 40, "\n".join([prose(7, 9)] * 6), "#*$%&|<> " * 60 + prose(8, 60)]
    out += [lines(20 + i, 5) for i in range(12)]
    return out


def documents(spark, texts_, extra: bool = True, sources=("s1", "s2", None)):
    """documents with repeated ids and rows, null ids, and columns whose names the operators use inside."""
    rows = [(i, t, "en", sources[i % len(sources)], None if t is None else len(t)) for i, t in enumerate(texts_)]
    if extra:
        n = len(rows)
        rows += [rows[n // 2], rows[n // 2], (3, texts_[n - 1], "en", "s1", 1), (None, texts_[n - 2], "en", "s1", 1), (None, None, None, None, None)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    names = ["fp", "node", "label", "row", "host", "kept", "words", "line", "rank", "group", "text_hash", "kind", "length", "first", "start"]
    df = spark.createDataFrame(rows, kind)
    if extra:
        df = df.selectExpr("*", *[f"{k}L AS {c}" for k, c in enumerate(names)])
    return df


def plain(df) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
