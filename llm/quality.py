"""Document quality rules with host-level verdicts, in DataFrame functions only.

Each text is measured once (one row in, one row out, no shuffle).  Failures of
five rules are counted per host (``source``), which Spark combines before the
shuffle, so a host with a third of all rows costs one row per task.  A host's
failure rate of a rule is shrunk to the corpus by a beta prior fitted to all
hosts (method of moments), so that hosts of few documents aren't judged by
them; a host is rejected when a shrunk rate passes ``max_rate``.  Verdicts of
rejected hosts go to shared storage and are joined back; Catalyst broadcasts
that table if its files are below its threshold, else adaptive execution
splits the hot hosts of the join.

Defined cases: null text counts as empty; a null host is a host of its own;
repeated rows count and are judged each; with no rows there is no verdict.
Other columns are passed through untouched or not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import SPACE, materialise, table, text_of

WORD = r"[^\x20\x09-\x0D]"
SYMBOL = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host goes when its shrunk failure rate of a rule is above this.
MAX_RATE = 0.9
RULES = ("short", "repeats", "symbols", "lines", "lengths")

# x -> is x in the sorted array d: a scan of few elements, else binary search.
_IN = """CASE WHEN size(d) <= 16 THEN array_contains(d, {x}) ELSE
  d[aggregate(sequence(bits - 1, 0, -1), 0, (at, k) ->
      IF(at + shiftleft(1, k) < size(d) AND d[at + shiftleft(1, k)] <= {x}, at + shiftleft(1, k), at))] = {x} END"""

# Words in 3-word windows that occur twice or more.  transform(array(e), v -> ..)[0]
# names the value e, so that it's computed once.  w: words, h: their hashes,
# g: the windows' 64-bit hashes, s: g sorted, d: values s has twice or more.
_REPEATS = f"""
IF(size(w) < 3, 0L, transform(array(transform(w, x -> xxhash64(x))), h ->
 transform(array(transform(sequence(0, size(h) - 3), i -> xxhash64(h[i], h[i + 1], h[i + 2]))), g ->
  transform(array(sort_array(g)), s ->
   transform(array(array_distinct(filter(s, (x, i) -> i > 0 AND x = s[i - 1]))), d ->
    IF(size(d) = 0, 0L, transform(array(cast(ceil(log2(size(d) + 1)) AS int)), bits ->
     aggregate(filter(sequence(0, size(g) - 1), i -> {_IN.format(x='g[i]')}),
      named_struct('n', 0L, 'last', -3),
      (a, i) -> named_struct('n', a.n + least(3, i - a.last), 'last', i), a -> a.n))[0])
   )[0])[0])[0])[0])"""


def measures() -> Column:
    """A struct of the measures of ``__text``."""
    trimmed = F.expr(r"btrim(__text, concat(' ', char(9), char(10), char(11), char(12), char(13)))")
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))
    lines = F.filter(F.split(F.col("__text"), "\n", -1), lambda x: x.rlike(WORD))
    symbols = F.regexp_count(F.col("__text"), F.lit(SYMBOL)).cast("bigint")
    values = F.struct(words.alias("words"), lines.alias("lines"), symbols.alias("n_symbols"))
    return F.transform(F.array(values), lambda v: F.struct(
        F.size(v["words"]).cast("bigint").alias("n_words"),
        F.length(F.array_join(v["words"], "")).cast("bigint").alias("word_chars"),
        v["n_symbols"].alias("n_symbols"),
        F.size(v["lines"]).cast("bigint").alias("n_lines"),
        (F.size(v["lines"]) - F.size(F.array_distinct(v["lines"]))).cast("bigint").alias("n_dup_lines"),
        v["words"].alias("words")))[0]


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` of each row with its measures and base_failed."""
    rows = docs.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)], text_of().alias("__text"))
    rows = rows.select(*[f"__k{i}" for i in range(len(keep))], measures().alias("m"))
    repeats = F.expr(f"transform(array(m.words), w -> {_REPEATS})[0]")
    named = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    rows = rows.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], *[f"m.{c}" for c in named], repeats.alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def failures() -> dict[str, Column]:
    """Each rule's failure as a condition on the measures."""
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "lengths": (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 12 * n),
    }


def rejected_hosts(rows: DataFrame, host: str, max_rate: float = MAX_RATE) -> DataFrame:
    """(host, rates) of the hosts whose shrunk failure rate of a rule is above max_rate."""
    hosts = materialise(rows.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n"), *[
        F.sum(c.cast("bigint")).alias(r) for r, c in failures().items()]), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), *[(F.sum(r) / F.sum("n")).alias(r) for r in RULES]).first()  # one row
    if not total["n"]:
        return hosts.select("host").limit(0)
    spread = hosts.agg(*[F.sum(F.col("n") * F.pow(F.col(r) / F.col("n") - F.lit(float(total[r])), F.lit(2))).alias(r) for r in RULES]).first()
    rates = {}
    for r in RULES:
        mean, variance = float(total[r]), max(float(spread[r]) / total["n"], 1e-12)
        weight = min(max(mean * (1 - mean) / variance - 1, 1.0), 1e6)
        rates[r] = (F.col(r) + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))
    return hosts.select("host", *[x.alias(r) for r, x in rates.items()]).filter(" OR ".join(f"{r} > {max_rate}D" for r in RULES))


def judged(docs: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """doc_id, host, the measures, base_failed and kept of every row."""
    rows = materialise(measured(docs, "doc_id", host), "quality")
    bad = materialise(rejected_hosts(rows, host, max_rate).select(F.col("host").alias("__host"), F.lit(True).alias("__bad")), "bad-hosts")
    return (rows.join(bad, rows[host].eqNullSafe(bad["__host"]), "left")
            .withColumn("kept", ~F.col("base_failed") & F.col("__bad").isNull()).drop("__host", "__bad"))


def quality_filter(docs: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as given."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(host).alias("host"), F.col("text"))
    bad = materialise(rejected_hosts(measured(docs, host), host, max_rate).select(F.col("host").alias("__host")), "bad-hosts")
    good = measured(rows, "row", "host").filter(~F.col("base_failed"))
    return good.join(bad, good["host"].eqNullSafe(bad["__host"]), "left_anti").select("row.*")


def op4_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM g) WHERE c > 1),
cover AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
l AS (SELECT rid, count(*) AS n_lines, count(DISTINCT x) AS n_unlike
      FROM (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT d.rid, doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
      len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_lines, 0) AS n_lines,
      coalesce(n_lines - n_unlike, 0)::BIGINT AS n_dup_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words
      FROM d JOIN w USING (rid) LEFT JOIN l USING (rid) LEFT JOIN cover USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
r AS (SELECT source, rule, count(*) AS n, sum(failed::INT) AS k FROM (
      SELECT source, unnest(['short', 'repeats', 'symbols', 'lines', 'lengths']) AS rule,
      unnest([n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > n_words, 10 * n_dup_lines > 3 * n_lines,
              word_chars < 3 * n_words OR word_chars > 12 * n_words]) AS failed FROM f) GROUP BY source, rule),
p AS (SELECT rule, sum(k) / sum(n) AS mean FROM r GROUP BY rule),
v AS (SELECT rule, mean, least(greatest(mean * (1 - mean) / greatest(sum(n * (k / n - mean) ** 2) / sum(n), 1e-12) - 1, 1), 1e6) AS weight
      FROM r JOIN p USING (rule) GROUP BY rule, mean),
bad AS (SELECT DISTINCT source FROM r JOIN v USING (rule) WHERE (k + mean * weight) / (n + weight) > 0.9)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM f.source) AS kept FROM f
"""
