"""The whole pipeline against plain versions of its stages, and the registered queries over the test tables."""

from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from llm import packing, stages
from llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMALL
from tests.llm import brute, fixtures
from tests.llm.test_operators import plain_line_dedup
from tests.oracle_compare import compare


def test_names():
    assert [k.split("_")[0] for k in QUERIES] == [f"op{n}" for n in range(1, 14)] + ["pipeline"]
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_their_oracle(spark, name):
    r = compare(spark, name, SMALL, QUERIES[name], ORACLE_SQL[name])
    assert r["match"], r


def test_run(spark, tmp_path):
    texts_ = [t for t in fixtures.texts() if t is None or len(t) < 4000]
    texts_ += ["Write to a.b@mail.example.com or 10.1.2.3 now. " + fixtures.prose(300 + i, 70) for i in range(4)]
    texts_ += [fixtures.lines(400 + i, 9) for i in range(8)]
    docs = fixtures.documents(spark, texts_, extra=False)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set("spark.llm.pii.key", "the test's")
    try:
        got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.llm.pii.key")

    rows = [(i, t) for i, t in fixtures.plain(docs) if not brute.measures(t)[-1]]
    rows = list(plain_line_dedup(rows))
    groups = brute.simhash_groups(rows)
    rows = [(i, t) for i, t in rows if groups[i, brute.simhash(t)] == i]
    left = list(zip([i for i, _ in rows], brute.pii([t for _, t in rows], "the test's")))
    assert sum(t != u for (_, t), (_, u) in zip(rows, left)) >= 4
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    want = Counter((i, *p) for i, t in left for p in brute.pieces(t, tokenizer))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want


def test_stages_keep_the_columns(spark):
    docs = fixtures.documents(spark, fixtures.texts())
    for stage in (stages.quality_rules, stages.lines, stages.near_duplicates, stages.surrogates):
        out = stage(spark, docs, "")
        assert out.dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), "").count() == 0
    for r in stages.surrogates(spark, docs, "").filter("text IS NOT NULL").collect():
        assert r["n_chars"] == len(r["text"])


def test_the_line_stage_finds_lines_with_a_changed_word(spark):
    base = [fixtures.prose(500 + i, 8 + 6 * i) for i in range(6)]
    changed = [" ".join(w if k != 3 else "xylophones"[:len(w) + 1] for k, w in enumerate(t.split())) for t in base]
    rows = [(0, "\n".join(base)), (1, "\n".join(changed)), (2, fixtures.prose(600, 30))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert dict(fixtures.plain(stages.lines(spark, df, ""))) == {**dict(rows), 1: ""}
