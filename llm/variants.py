"""Spelling variants: words one edit apart, found by a frontier of states on a trie.

The vocabulary's trie is a distributed table of edges.  Runs of nodes without
a branch are one edge, so that an edge has a label of one or more code points
and a long word costs few levels.  A state is (word, position, node, edits):
the word's first ``position`` code points lead to ``node`` with so many edits.
Level by level all states are joined with the edges of their nodes: a label
that equals what follows in the word moves a state on; a state without edits
may also replace or delete a code point at an edge that isn't its own.  A state
with one edit that ends with its word at a word's node is a neighbour.  Every
pair is found from one side, from the longer word or, if a code point is
replaced, from the word with the smaller one, and counts for both.

Near the root every word could turn off to most of the trie.  So there are two
tries, of words and of words read backwards, and a word only turns off in the
second half of either: an edit in its first half is in the second half when
read backwards.  Edges have a signature, two 64-bit sets of what the words
below have after the edge's first code point; a state that its word's rest
isn't in doesn't take the edge.

Nodes are named by 64-bit hashes of their prefixes.  A neighbour counts only
if the vocabulary holds it, so that equal hashes can't make one up; a node
that two prefixes share has the edges of both.  A node with many words is
dealt to several keys, its edges copied to each: one key per ``SPLIT`` words.

Defined cases: a null text has no words; a null id is empty in what is
hashed; repeated rows count as often as they stand there; an empty table has
no words; words of any length take part; of near words with equal counts the
smaller in code-point order is the form.  Other columns, whatever their names,
take no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import materialise, release, table, text_of

LETTERS = "[A-Za-zÀ-ÿ]"
#: Least code points and occurrences of a word; how much more frequent a form is.
LEAST, TWICE, RATIO = 7, 2, 10
#: The query's share of words that lose a code point in a document, one in so many.
DAMAGE = 31
#: Words under a node that share a key of the join.
SPLIT = 4096
#: Path rows, or counted words, that a Python worker holds at a time, about.
HELD = 200_000
REPLACE, DELETE = 1, 2


def counted(docs: DataFrame, least: int = LEAST, twice: int = TWICE, damage: int | None = None) -> DataFrame:
    """(word, n) of the words of ``docs`` with at least ``least`` code points and ``twice`` occurrences or more.

    Words are the maximal runs of letters, A-Z lower-cased.  With ``damage``, a
    run loses a code point in each document where that number divides the CRC-32
    of "<doc_id>:<run>"; the code point is the CRC-32 modulo the run's length.
    Workers add up what they have seen and pass it on whenever it's ``HELD`` words.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, seen = re.compile(f"{LETTERS}{{{least},}}").findall, Counter()
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = Counter(find(text.as_py().encode().lower().decode()))  # bytes: A-Z only
                if not damage:
                    seen.update(words)
                else:
                    start = crc32(f"{doc}:".encode())
                    for word, n in words.items():
                        if not (h := crc32(word.encode(), start)) % damage:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < least:
                                continue
                        seen[word] += n
                if len(seen) >= HELD:
                    yield sums(seen)
                    seen.clear()
        yield sums(seen)

    def sums(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), text_of().alias("text"))
    found = rows.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= twice)


def paths(oriented: DataFrame, first: int) -> DataFrame:
    """(way, t, d, node, ch): the node of each prefix of at least ``first`` code points, and what follows it (0: nothing)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64)
            sizes = np.array([len(t) for t in texts], np.int64)
            order = np.argsort(-sizes, kind="stable")
            size, start = sizes[order], (np.cumsum(sizes) - sizes)[order]
            node = (b.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)[order] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            out, held = [], 0
            for d in range(int(size[0]) + 1 if len(size) else 0):
                there, on = (int(np.searchsorted(-size, -x, "right")) for x in (d, d + 1))
                ch = points[start[:on] + d]
                if d >= first:
                    follow = np.zeros(there, np.int32)
                    follow[:on] = ch
                    out.append((order[:there], np.full(there, d, np.int32), node[:there].copy(), follow))
                    held += there
                    if held >= HELD:
                        yield batch(b, out)
                        out, held = [], 0
                mixed = (node[:on] ^ ch) * np.uint64(0xD6E8FEB86659FD93)
                node[:on] = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
            if out:
                yield batch(b, out)

    def batch(b: pa.RecordBatch, out: list) -> pa.RecordBatch:
        row, d, node, ch = (np.concatenate(c) for c in zip(*out))
        row = pa.array(row)
        return pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), pa.array(d), pa.array(node.view(np.int64)), pa.array(ch)],
                                          ["way", "t", "d", "node", "ch"])

    return oriented.select("way", "t").mapInArrow(run, "way int, t string, d int, node long, ch int")


def _signature(rest: Column) -> tuple[Column, Column]:
    h = F.xxhash64(rest)
    return tuple(F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(63).cast("int")) for x in (h, F.shiftrightunsigned(h, 6)))


def _key(t: Column, words: Column) -> Column:
    return F.pmod(F.xxhash64(t), F.ceil(words / SPLIT))


def trie(words: DataFrame, first: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edges by level, first states, the table these come from) of the two tries below the prefixes of ``first`` code points."""
    oriented = words.select(F.explode(F.array(*[F.struct(F.lit(w).alias("way"), t.alias("t")) for w, t in
                                                ((0, F.col("word")), (1, F.reverse("word")))])).alias("o")).select("o.*")
    rows = paths(oriented, first)
    nodes = rows.groupBy("node").agg(F.min("ch").alias("lo"), F.max("ch").alias("hi"), F.min("d").alias("at"), F.count("*").alias("words"))
    nodes = nodes.filter((F.col("lo") != F.col("hi")) | (F.col("at") == first)).select("node", "words")
    kept = rows.join(nodes, "node", "left").filter("words IS NOT NULL OR ch = 0")
    step = F.struct("d", "node", F.coalesce("words", F.lit(1).cast("long")).alias("words"))
    whole = materialise(kept.groupBy("way", "t").agg(F.sort_array(F.collect_list(step)).alias("steps")), "trie-paths")

    edges = whole.select("t", "steps", F.posexplode(F.slice("steps", 2, F.size("steps"))).alias("level", "to"))
    edges = edges.withColumn("from", F.col("steps")[F.col("level")])
    one, two = _signature(F.col("t").substr(F.col("from.d") + 2, F.length("t")))
    label = F.col("t").substr(F.col("from.d") + 1, F.col("to.d") - F.col("from.d"))
    edges = edges.select("level", F.col("from.node").alias("node"), F.col("from.words").alias("above"), F.col("to.node").alias("child"),
                         F.col("to.words").alias("below"), label.alias("label"), one.alias("one"), two.alias("two"),
                         (F.col("to.d") == F.length("t")).alias("final"))
    edges = edges.groupBy("level", "node", "above", "child", "below", "label").agg(
        F.bit_or("one").alias("one"), F.bit_or("two").alias("two"), F.max("final").alias("final"))
    keys = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("above") / SPLIT) - 1))
    edges = edges.withColumn("key", keys).drop("above").withColumn("ch", F.ascii("label"))
    start = F.col("steps")[0]
    states = whole.select("way", "t", start["d"].alias("pos"), start["node"].alias("node"), _key(F.col("t"), start["words"]).alias("key"),
                          F.lit(0).alias("edits"), F.lit(0).alias("at"), F.lit("").alias("c"))
    return materialise(edges, "trie-edges", by="level"), states, whole


def _advanced(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States one edge further; ``found``: at a neighbour, ``open``: to go on.

    What a state takes an edge by is worked out before the join, as numbers: the
    code points at and after its place, and the signatures of the rests.
    """
    t, label, pos, edits, ch = (F.col(c) for c in ("t", "label", "pos", "edits", "ch"))
    size, long = F.length("t"), F.length("label")
    half = F.floor(size / 2).cast("int")

    def part(start: Column, length: Column) -> Column:  # start counts from 0
        return t.substr(start + 1, length)

    states = states.withColumn("ch0", F.ascii(part(pos, F.lit(1)))).withColumn("ch1", F.ascii(part(pos + 1, F.lit(1))))
    for name, start in (("same", pos + 1), ("less", pos + 2)):
        one, two = _signature(part(start, size))
        states = states.withColumn(f"{name}1", one).withColumn(f"{name}2", two)
    states = states.withColumn("turns", (edits == 0) & (pos >= F.when(F.col("way") == 0, half).otherwise(size - half)))

    def holds(name: str) -> Column:
        return (F.col("one").bitwiseAND(F.col(f"{name}1")) != 0) & (F.col("two").bitwiseAND(F.col(f"{name}2")) != 0)

    own = (ch == F.col("ch0")) & ((edits == 0) | holds("same"))
    replaced = F.col("turns") & (ch > F.col("ch0")) & holds("same")
    deleted = F.col("turns") & (ch == F.col("ch1")) & (ch != F.col("ch0")) & holds("less")
    went = states.join(edges, ["node", "key"]).filter(own | replaced | deleted)
    tail, short = label.substr(F.lit(2), long), long == 1
    fits = ((F.lit(0), own & ((edits == 0) | short | (part(pos, long) == label)), pos + long),
            (F.lit(REPLACE), replaced & (short | (part(pos + 1, long - 1) == tail)), pos + long),
            (F.lit(DELETE), deleted & (short | (part(pos + 1, long) == label)), pos + long + 1))
    went = went.withColumn("ways", F.array(*[F.when(ok, to) for _, ok, to in fits])).select("*", F.posexplode("ways").alias("kind", "to")).filter("to <= length(t)")
    first = (edits == 0) & (F.col("kind") > 0)
    went = (went.withColumn("at", F.when(first, pos).otherwise(F.col("at"))).withColumn("c", F.when(first, label.substr(F.lit(1), F.lit(1))).otherwise(F.col("c")))
            .withColumn("edits", F.greatest(edits, F.col("kind"))).withColumn("pos", F.col("to")))
    # All but the last code point without an edit, at a word's node: the last one is deleted.
    went = went.withColumn("end", (edits == 0) & (pos == size - 1) & F.col("final"))
    went = went.withColumn("found", (edits > 0) & (pos == size) & F.col("final"))
    went = went.withColumn("open", (pos < size) & ((edits > 0) | (F.col("below") > 1)))
    return went.filter("found OR open OR end").select(
        "way", "t", "pos", F.col("child").alias("node"), _key(t, F.col("below")).alias("key"), "edits", "at", "c", "found", "open", "end")


def neighbours(words: DataFrame, least: int = LEAST) -> DataFrame:
    """(word, near, n): for each (word, n), of at least ``least`` code points, the words one edit away with their n."""
    edges, states, whole = trie(words, max(1, least // 2))
    levels = edges.agg(F.max("level")).first()[0]
    if levels is None:
        return words.select("word", F.col("word").alias("near"), "n").limit(0)
    t, at = F.col("t"), F.col("at")
    before, ends = t.substr(F.lit(1), at), F.length("t")
    spelled = (F.when(F.col("end"), t.substr(F.lit(1), ends - 1))
               .when(F.col("edits") == REPLACE, F.concat(before, F.col("c"), t.substr(at + 2, ends)))
               .otherwise(F.concat(before, t.substr(at + 2, ends))))

    def forwards(x: Column) -> Column:
        return F.when(F.col("way") == 0, x).otherwise(F.reverse(x))

    pairs, tables = [], [edges, whole]
    for level in range(levels + 1):
        step = materialise(_advanced(states, edges.filter(F.col("level") == level).drop("level")), "frontier")
        tables.append(step)
        states = step.filter("open").drop("found", "open", "end")
        pairs.append(step.filter("found OR end").select(forwards(t).alias("word"), forwards(spelled).alias("near")))
    one_way = reduce(DataFrame.unionByName, pairs).distinct()
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("m"))
    one_way = one_way.join(counts, "near").join(words.select("word", "n"), "word")  # both are words
    both = F.array(F.struct("word", "near", F.col("m").alias("n")), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), "n"))
    out = materialise(one_way.select(F.explode(both).alias("p")).select("p.*"), "near")
    release(*tables)
    return out


def variant_groups(words: DataFrame, least: int = LEAST, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each (word, n)."""
    near = neighbours(words, least)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("best"))
    form_n = -F.col("best.less")
    told = words.join(best, "word", "left").withColumn("is", form_n >= ratio * F.col("n")).select(
        "word", F.when(F.col("is"), F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("is"), form_n).alias("form_n"))
    told = materialise(told, "told")
    release(near)
    # n grows by the ratio at each form, so log(n) steps reach the last one; pointers double.
    most = told.agg(F.max("n")).first()[0] or 1
    roots = told.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    reach, steps = 1, max(1, math.floor(math.log(most) / math.log(ratio)) + 1)
    while reach < steps:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialise(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        reach *= 2
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(materialise(counted(table(spark, sf_dir, "documents"), damage=DAMAGE), "vocabulary"))


_BYTES = "list_transform(range(1, 2 * octet_length(encode({0})), 2), lambda i: cast('0x' || substr(hex(encode({0})), i, 2) as bigint))"
_CRC = ("xor(list_reduce(" + _BYTES.format("concat(coalesce(cast(doc_id as varchar), ''), ':', run)") + ", lambda a, b: list_reduce(range(8),"
        " lambda c, j: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, xor(a, b)), cast(4294967295 as bigint)), 4294967295)")
OP11_SQL = f"""with recursive
r as (select doc_id, translate(unnest(regexp_extract_all(text, '{LETTERS}{{7,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents),
u as (select doc_id, run, count(*) as k, {_CRC} as h from r group by doc_id, run),
s as (select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, k from u),
w as (select word, cast(sum(k) as bigint) as n from s where length(word) >= 7 group by word having sum(k) >= 2),
d as (select word, n, unnest(range(1, length(word) + 1)) as i from w),
v as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as cut from d),
p as (select distinct word, near, n from (
 select a.word, b.word as near, b.n from v a join v b on a.i = b.i and a.cut = b.cut and a.word <> b.word
 union all select v.word, w.word, w.n from v join w on w.word = v.cut
 union all select w.word, v.word, v.n from v join w on w.word = v.cut)),
b as (select word, count(*) as n_near, arg_min(struct_pack(form := near, n := n), struct_pack(m := -n, near := encode(near))) as best from p group by word),
f as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when best.n >= 10 * w.n then best.form end as form, case when best.n >= 10 * w.n then best.n end as form_n
 from w left join b on w.word = b.word),
t as (select word, form as goal, 1 as k from f where form is not null
 union all select t.word, f.form, k + 1 from t join f on f.word = t.goal where f.form is not null)
select f.word, form, coalesce((select arg_max(goal, k) from t where t.word = f.word), f.word) as root, n, n_near, form_n from f"""
