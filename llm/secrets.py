"""Secret scan over a trigram inverted index, in DataFrame functions only.

1. From each rule's regex a Boolean trigram query is derived: clauses that all
   must hold, each a choice of literal strings, each string all its trigrams.
   Optional parts, classes and repeats count only with what they must contain.
2. The index holds a posting (trigram, doc_id) for each trigram of any query
   that a document's lower-cased text has; postings are intersected per
   document, which gives the rules each document is a candidate of.
3. Candidates join their texts again and only their rules are matched there;
   rules without mandatory trigrams are matched in every text.

A match's place comes from splitting the text at the rule's matches: offsets
are running sums of the lengths (in code points) of pieces and matches, added up
block by block, so that a text with many matches costs in proportion to them.

Defined cases: null text counts as empty; null doc_id rows are scanned like
others; rows that repeat a doc_id share candidates (a superset) and are each
matched on their own text, so their results are their own; an empty table gives
an empty result; texts of any length are scanned whole, by patterns that look
at a place a bounded number of times; of matches with one start the kinds'
order decides; other columns, whatever their names, take no part.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as sre_constants
from re import _parser as sre_parse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import materialise, table, text_of


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base kinds in the order that breaks ties of a start.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # the runs of [0-9a-f]+ of 24 or more
)
#: Kinds that the scan adds: prefixes that vendors document, keys in PEM, JSON web tokens.
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
#: Lengths that are added up at a time.
BLOCK = 256
#: Strings that a part's set may have before the part counts as unknown.
EXACT = 64

Clause = frozenset  # of alternatives, each a frozenset of trigrams


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses over lower-cased trigrams that every match's text satisfies; none: a full scan."""
    clauses: set[Clause] = set()

    def close(strings: set[str] | None) -> None:
        if strings and all(len(s) >= 3 for s in strings):
            ways = {trigrams(s) for s in strings}
            clauses.add(frozenset(w for w in ways if not any(v < w for v in ways)))

    def expand(node) -> set[str] | None:
        """The lower-cased strings that a node matches, or None where they're too many."""
        op, arg = node
        if op is sre_constants.LITERAL:
            return {chr(arg).lower()}
        if op is sre_constants.IN:
            out: set[str] = set()
            for kind, value in arg:
                if kind is sre_constants.LITERAL:
                    out.add(chr(value).lower())
                elif kind is sre_constants.RANGE and value[1] - value[0] < 8:
                    out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
                else:
                    return None
            return out
        if op is sre_constants.SUBPATTERN:
            return sequence(arg[-1])
        if op is sre_constants.BRANCH:
            parts = [sequence(x) for x in arg[1]]
            return None if any(p is None for p in parts) else set().union(*parts)
        if op is sre_constants.MAX_REPEAT and arg[1] is not sre_constants.MAXREPEAT:
            inner = sequence(arg[2])
            if inner is not None and len(inner) <= 4 and arg[1] <= 2:
                return {"".join(t) for n in range(arg[0], arg[1] + 1) for t in product(inner, repeat=n)}
        return {""} if op is sre_constants.AT else None

    def sequence(nodes) -> set[str] | None:
        out = {""}
        for node in nodes:
            strings = expand(node)
            if strings is None or len(out) * len(strings) > EXACT:
                return None
            out = {a + b for a in out for b in strings}
        return out

    def walk(nodes) -> None:
        run: set[str] = {""}
        for node in nodes:
            strings = expand(node)
            if strings is not None and len(run) * len(strings) <= EXACT:
                run = {a + b for a in run for b in strings}
                continue
            close(run)
            run = strings if strings is not None and len(strings) <= EXACT else {""}
            if strings is None:
                op, arg = node
                if op is sre_constants.SUBPATTERN:
                    walk(arg[-1])
                elif op is sre_constants.MAX_REPEAT and arg[0] > 0:
                    walk(arg[2])
        close(run)

    walk(sre_parse.parse(pattern))
    return sorted(clauses, key=lambda c: sorted(map(sorted, c)))


def postings(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The inverted index (trigram, doc_id) for the trigrams of the rules' queries."""
    wanted = sorted({t for r in rules for c in trigram_query(r.pattern) for way in c for t in way})
    rows = docs.select("doc_id", F.lower(text_of()).alias("low"))
    has = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted]))
    return rows.select(F.explode(has).alias("trigram"), "doc_id")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, kinds): the rules whose trigram query a document's postings satisfy."""
    def holds(rule: Rule) -> Column:
        met = F.lit(True)
        for clause in trigram_query(rule.pattern):
            way = F.lit(False)
            for grams in sorted(map(sorted, clause)):
                way = way | (F.size(F.array_intersect("have", F.lit(list(grams)))) == len(grams))
            met = met & way
        return met

    asked = [r for r in rules if trigram_query(r.pattern)]
    have = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("have"))
    kinds = F.array_compact(F.array(*[F.when(holds(r), F.lit(r.kind)) for r in asked]))
    return have.select("doc_id", kinds.alias("kinds")).filter(F.size("kinds") > 0)


SPANS = "array<struct<start:int,kind:int,stop:int>>"


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it's used."""
    return F.transform(F.array(value), use)[0]


def running(lengths: Column) -> Column:
    """The sums of the lengths before each one.

    ``array_append`` copies what it appends to; so sums are taken in blocks of
    ``BLOCK``, and only the blocks' totals over the whole array.
    """
    none = F.array().cast("array<int>")

    def before(values: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), none.alias("out"))
        return F.aggregate(values, start, lambda a, v: F.struct((a["at"] + v).alias("at"), F.array_append(a["out"], a["at"]).alias("out")), lambda a: a["out"])

    def by_blocks(n: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(n) - 1) / BLOCK).cast("int")), lambda b: F.slice(n, b * BLOCK + 1, BLOCK))
        total = F.transform(cut, lambda c: F.aggregate(c, F.lit(0), lambda a, v: a + v))
        both = F.struct(cut.alias("cut"), total.alias("total"))
        return _bound(both, lambda x: _bound(before(x["total"], F.lit(0)), lambda first: F.flatten(
            F.transform(x["cut"], lambda c, b: before(c, F.get(first, b))))))

    return _bound(lengths, lambda n: F.when(F.size(n) == 0, none).otherwise(by_blocks(n)))


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Spans (start, ``order``, stop) of a rule's matches in a text."""
    def lengths(strings: Column) -> Column:
        return F.transform(strings, lambda x: F.length(x))

    def found(p: Column) -> Column:
        both = F.zip_with(p["gap"], p["whole"], lambda g, w: F.coalesce(g, F.lit(0)) + F.coalesce(w, F.lit(0)))
        each = F.arrays_zip(p["gap"].alias("gap"), p["whole"].alias("whole"), p["value"].alias("value"), running(both).alias("at"))
        some = F.filter(each, lambda m: m["value"] >= rule.least)
        return F.transform(some, lambda m: F.struct((m["at"] + m["gap"]).alias("start"), F.lit(order).alias("kind"),
                                                    (m["at"] + m["gap"] + m["whole"]).alias("stop")))

    def parts() -> Column:
        return F.struct(lengths(F.split(text, rule.pattern, -1)).alias("gap"),
                        lengths(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))).alias("whole"),
                        lengths(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))).alias("value"))

    return _bound(parts(), found)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED) -> DataFrame:
    """(doc_id, found): each row's spans (start, kind's number in ``rules``, stop), sorted."""
    index = materialise(postings(docs, rules), "postings")
    kinds = candidates(index, rules).select(F.col("doc_id").alias("__id"), "kinds")
    rows = docs.select("doc_id", text_of().alias("text"))
    rows = rows.join(kinds, rows["doc_id"].eqNullSafe(kinds["__id"]), "left")
    empty = F.array().cast(SPANS)
    columns = []
    for k, rule in enumerate(rules):
        asked = F.array_contains("kinds", rule.kind) if trigram_query(rule.pattern) else F.lit(True)
        columns.append(F.when(asked, spans_of(F.col("text"), rule, k).cast(SPANS)).otherwise(empty))
    return rows.select("doc_id", F.array_sort(F.concat(*columns)).alias("found"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = BASE + ADDED
    rows = scan(table(spark, sf_dir, "documents"), rules)
    names = F.lit([r.kind for r in rules])

    def listed(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda x: F.concat_ws(":", names[x["kind"]], x["start"], x["stop"])), ",")

    base = F.filter("found", lambda x: x["kind"] < len(BASE))

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint")

    counts = [count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    return rows.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


def _oracle(rules: tuple[Rule, ...] = BASE + ADDED) -> str:
    """DuckDB SQL for op3_secret_scan: each kind's gaps and matches, and running sums of their lengths.

    Its regexes know neither lookbehind nor a case that's folded in ASCII only: a
    character before a match is made part of it, and the base rule's letters are spelled out.
    """
    def either(pattern: str) -> str:
        words, rest = pattern.removeprefix("(?i)").split(")", 1)
        return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words) + ")" + rest

    parts = []
    for k, rule in enumerate(rules):
        pattern, group, own = rule.pattern, rule.group, 0
        if pattern.startswith("(?i)"):
            pattern = either(pattern)
        if pattern.startswith("(?<!"):
            before, rest = pattern.removeprefix("(?<![").split("])", 1)
            pattern, own = f"(^|[^{before}])({rest})", 2
        p = "'" + pattern.replace("'", "''") + "'"
        parts.append(f"""select r, {k} as k, unnest(range(1, len(whole) + 1)) as i, gap, whole, own, val from (
 select r, list_transform(string_split_regex(t, {p}), lambda x: length(x)) as gap, list_transform(regexp_extract_all(t, {p}), lambda x: length(x)) as whole,
  list_transform(regexp_extract_all(t, {p}, {own}), lambda x: length(x)) as own, list_transform(regexp_extract_all(t, {p}, {group}), lambda x: length(x)) as val from d)""")
    least = " ".join(f"when {k} then {r.least}" for k, r in enumerate(rules))
    names = " ".join(f"when {k} then '{r.kind}'" for k, r in enumerate(rules))
    counts = ", ".join(f"count(*) filter (k = {k}) as n_{r.kind}" for k, r in enumerate(BASE))
    return f"""with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
m as ({' union all '.join(parts)}),
s as (select r, k, list_sum(gap[1:i]) + coalesce(list_sum(whole[1:i - 1]), 0) + whole[i] as stop, own[i] as size from m where val[i] >= case k {least} end),
x as (select r, k, cast(stop - size as bigint) as start, case k {names} end || ':' || cast(stop - size as bigint) || ':' || cast(stop as bigint) as span from s),
g as (select r, {counts}, sha256(coalesce(string_agg(span, ',' order by start, k) filter (k < {len(BASE)}), '')) as base_sha256,
 string_agg(span, ',' order by start, k) as spans from x group by r)
select doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) as n_{r.kind}' for r in BASE)}, coalesce(base_sha256, sha256('')) as base_sha256, coalesce(spans, '') as spans
from d left join g on d.r = g.r"""


OP3_SQL = _oracle()
