"""Merkle manifest of a dataset, with a proof for every row by pointer jumping.

Rows are leaves.  Per source, ordered by id, every 16 consecutive nodes become
one until a subroot is left; the subroots, ordered by source, likewise become
the root.  A node's edge is what folds it into its parent: the digests of its
left and of its right siblings.

Proofs come from the edges by pointer jumping.  Every node knows an ancestor
and the segment of edges up to it, at first its parent and one edge.  A round
joins the table with itself on the ancestor: a node takes over its ancestor's
ancestor and appends its segment, so the distance doubles and the proofs of a
tree of height h are whole after log2(h) rounds.  Leaves are nobody's
ancestors, so they are kept apart and only the inner nodes are looked up.

Places in the order are found without gathering a source: rows are dealt by
range and sorted, and a partition's start is the sum of the counts before it.
A join on the ancestor would bring all rows under one node together; so rows
meet their ancestor in stretches of ``STRETCH`` consecutive leaves, and a node
is copied once for each stretch it covers (n / STRETCH copies a level).

Defined cases: nulls count as ``-``.  A null source is the first source, a
null id the first of its source and never tampered with.  Rows of equal source
and id are ordered by their digests; repeated rows are leaves each.  Other
columns, whatever their names, take no part.  Texts of any length are hashed
whole.  An empty table has no root and gives an empty result; a lone leaf is
its own subroot, one source's subroot is the root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import materialise, release, table

FAN = 16
#: Leaves, in order, that meet an ancestor under one key.
STRETCH = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Node ids are level and first leaf in one number; levels above the subroots count from TOP.
SHIFT, TOP = 56, 64
NO_EDGES = "CAST(array() AS ARRAY<STRUCT<left: BINARY, right: BINARY>>)"


def digest(*fields: Column) -> Column:
    """The leaf of a row: SHA-256 over ``-`` for a null, else the UTF-8 length, a colon and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
             for c in (f.cast("string") for f in fields)]
    return F.sha2(F.concat(*parts), 256)


def numbered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` with their place (from 0) in the order of ``keys``, and the partition they're in.

    Rows with equal keys are spread by a tie-breaker, so that no key is one task's.
    """
    rows = rows.withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    rows = rows.repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie").drop("tie")
    rows = materialise(rows.withColumn("at", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("part", F.shiftright("at", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    starts = rows.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(F.broadcast(starts), "part").withColumn(name, F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("at", "start")


def _placed(leaves: DataFrame, by: str, order: str) -> DataFrame:
    """Leaves with g (place in all), tree (its source's first g), n (the source's leaves)."""
    rows = numbered(leaves, [by, order, "digest"], "g")
    # A row a source and partition; a source's window holds at most a row a partition.
    here = rows.groupBy("part", by).agg(F.min("g").alias("first"), F.count("*").alias("c"))
    whole = Window.partitionBy(by)
    here = here.select("part", F.col(by).alias("by"), F.min("first").over(whole).alias("tree"), F.sum("c").over(whole).alias("n"))
    here = here.withColumnRenamed("part", "p")
    return rows.join(here, (F.col("part") == F.col("p")) & F.col(by).eqNullSafe(F.col("by"))).drop("part", "p", "by")


def _node(level: int, first: Column) -> Column:
    return F.lit(level << SHIFT) + first


def _runs(nodes: DataFrame, level: int, fan: int, carried: list[str]) -> DataFrame:
    """A row for each run of ``fan`` nodes: its children in order and what they become."""
    kid = F.struct("pos", "id", "g0", "g1", F.unhex("digest").alias("digest"), *carried)
    runs = nodes.groupBy("tree", "n", F.floor(F.col("pos") / fan).alias("run")).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
    joined = F.concat_ws("", F.transform("kids", lambda k: F.lower(F.hex(k["digest"]))))
    return runs.select("tree", F.col("run").alias("pos"), F.ceil(F.col("n") / fan).alias("n"), F.sha2(joined, 256).alias("digest"),
                       F.col("kids")[0]["g0"].alias("g0"), F.element_at("kids", -1)["g1"].alias("g1"),
                       _node(level + 1, F.col("kids")[0]["g0"]).alias("id"), "kids")


def _edges(runs: DataFrame, carried: list[str]) -> DataFrame:
    """A row for each child: the parent (up) and the edge to it."""
    def bytes_of(part: Column) -> Column:
        return F.aggregate(part, F.expr("CAST('' AS BINARY)"), lambda a, k: F.concat(a, k["digest"]))

    rows = runs.select(F.col("id").alias("up"), "kids", F.posexplode("kids").alias("i", "kid"))
    edge = F.struct(bytes_of(F.slice("kids", 1, F.col("i"))).alias("left"),
                    bytes_of(F.slice("kids", F.col("i") + 2, F.size("kids"))).alias("right"))
    return rows.select("kid.id", "kid.g0", "kid.g1", "up", F.array(edge).alias("seg"), *[f"kid.{c}" for c in carried], "kid.digest")


def _grow(nodes: DataFrame, most: int, level: int, fan: int, carried: list[str]) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """(edges of each level, nodes that are left of a tree, tables to remove) for trees of up to ``most`` nodes."""
    edges, tops, tables = [], [], []
    while most > 1:
        tops.append(nodes.filter("n = 1"))
        runs = materialise(_runs(nodes.filter("n > 1"), level, fan, carried), "runs")
        tables.append(runs)
        edges.append(_edges(runs, carried))
        nodes, most, level, carried = runs.drop("kids"), -(-most // fan), level + 1, []
    return edges, [*tops, nodes], tables


def _jumped(rows: DataFrame, inner: DataFrame) -> DataFrame:
    """Each row's ancestor becomes that ancestor's, with the segment between them appended."""
    found = inner.select(F.col("id").alias("up"), F.col("up").alias("above"), F.col("seg").alias("more"), F.col("sub").alias("over"),
                         F.explode(F.sequence(F.floor(F.col("g0") / STRETCH), F.floor(F.col("g1") / STRETCH))).alias("stretch"))
    rows = rows.withColumn("stretch", F.floor(F.col("g0") / STRETCH)).join(found, ["up", "stretch"], "left")
    return (rows.withColumn("up", F.coalesce("above", "up")).withColumn("sub", F.coalesce("sub", "over"))
            .withColumn("seg", F.when(F.col("more").isNull(), F.col("seg")).otherwise(F.concat("seg", "more")))
            .drop("stretch", "above", "more", "over"))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, by: str = "source", order: str = "doc_id", fan: int = FAN,
             extra: dict[str, Column] | None = None) -> tuple[DataFrame, str | None]:
    """((``order``, digest, subroot, seg and ``extra``) of each row, the root).

    ``seg`` is the row's proof: an array of (left, right), from the leaf to the
    root, of concatenated binary sibling digests; digest and subroot are hex.
    """
    extra = extra or {}
    rows = docs.select(F.col(by).alias(by), F.col(order).alias(order), digest(*map(F.col, fields)).alias("digest"),
                       *[c.alias(k) for k, c in extra.items()])
    first = materialise(rows, "leaves")
    carried = [order, *extra]
    leaves = _placed(first, by, order).select("tree", "n", (F.col("g") - F.col("tree")).alias("pos"), _node(0, F.col("g")).alias("id"),
                                              F.col("g").alias("g0"), F.col("g").alias("g1"), "digest", *carried)
    leaves = materialise(leaves, "leaves")
    release(first)
    most, trees = leaves.agg(F.max("n"), F.count_if(F.col("pos") == 0)).first()
    shape = [order, "digest", "subroot", "seg", *extra]
    if not most:
        return leaves.withColumn("subroot", F.lit(None).cast("string")).withColumn("seg", F.expr(NO_EDGES)).select(shape), None

    edges, tops, tables = _grow(leaves, most, 0, fan, carried)
    subroots = reduce(DataFrame.unionByName, [t.select("id", "g0", "g1", "digest") for t in tops])
    height = len(edges)
    none = F.lit(None).cast("binary")
    inner = [e.select("id", "g0", "g1", "up", "seg", none.alias("sub")) for e in edges[1:]]
    if trees > 1:
        held = numbered(subroots, ["g0"], "pos").drop("part").withColumn("tree", F.lit(-1)).withColumn("n", F.lit(trees))
        over, last, more = _grow(held, trees, TOP, fan, [])
        inner += [e.select("id", "g0", "g1", "up", "seg", (none if i else F.col("digest")).alias("sub")) for i, e in enumerate(over)]
        tables += more
        height += len(over)
        root = last[-1].first()["digest"]
    else:
        root = subroots.first()["digest"]

    # Lone leaves are inner nodes too: they point to themselves there, with no edge.
    lone = leaves.filter("n = 1").withColumn("up", F.col("id")).withColumn("seg", F.expr(NO_EDGES)).withColumn("digest", F.unhex("digest"))
    wanted = ["g0", "up", "seg", "digest", *carried]
    walk = (edges[0].select(wanted).unionByName(lone.select(wanted)) if edges else lone.select(wanted)).withColumn("sub", none)
    if inner:
        known = materialise(reduce(DataFrame.unionByName, inner), "nodes")
        reach = 1
        while True:
            walk = _jumped(walk, known)
            if (reach := 2 * reach) >= height + 1:
                break
            known = materialise(_jumped(known, known), "nodes")
    if tables[1:]:
        release(*tables[1:])  # the first one's leaves are still to be read
    hexed = F.lower(F.hex("sub")) if trees > 1 else F.lit(root)
    return walk.select(order, F.lower(F.hex("digest")).alias("digest"), hexed.alias("subroot"), "seg", *extra), root


def folded(leaf: Column, seg: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(seg, leaf, lambda a, e: F.sha2(F.concat(F.lower(F.hex(e["left"])), a, F.lower(F.hex(e["right"]))), 256))


def proof_digest(seg: Column) -> Column:
    """SHA-256 over a proof's sibling digests (hex), level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(seg, lambda e: F.lower(F.hex(F.concat(e["left"], e["right"]))))), 256)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    other = F.when(tampered, digest(*[lower if c == "text" else F.col(c) for c in FIELDS]))
    rows, root = manifest(docs, extra={"other": other})
    back = folded(F.coalesce("other", "digest"), F.col("seg"))
    rows = rows.select("doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(root).cast("string").alias("root"),
                       proof_digest(F.col("seg")).alias("proof_sha256"), back.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def _level(name: str, after: str, partition: str) -> str:
    """SQL of the next level: every 16 nodes of a tree become one; a tree's last node stays as it is."""
    return f"""{name} as (
 select {partition}, pos // 16 as pos, case when any_value(n) = 1 then any_value(digest) else sha256(string_agg(digest, '' order by pos)) end as digest,
  cast(ceil(any_value(n) / 16.0) as bigint) as n from {after} group by {partition}, pos // 16)"""


def _oracle(levels: int = 5) -> str:
    """DuckDB SQL for op12_merkle_manifest, for up to 16 ** ``levels`` rows a source and sources."""
    def leaf(text: str) -> str:
        parts = [f"coalesce(cast(octet_length(encode(cast({c} as varchar))) as varchar) || ':' || cast({c} as varchar), '-')"
                 for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc_step = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
    crc = ("xor(list_reduce(list_transform(range(1, length(cast(doc_id as varchar)) + 1), lambda i: cast(ascii(substr(cast(doc_id as varchar), i, 1)) as bigint)), "
           f"lambda a, b: list_reduce(range(8), lambda c, j: {crc_step}, xor(a, b)), cast(4294967295 as bigint)), 4294967295)")
    ctes = [f"l as (select doc_id, source, {leaf('text')} as leaf, {leaf(low)} as low, {crc} as crc from documents)",
            "t as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,"
            " count(*) over (partition by source) as n, dense_rank() over (order by source nulls first) - 1 as tree from l)",
            "s0 as (select tree, pos, leaf as digest, n from t)"]
    ctes += [_level(f"s{k + 1}", f"s{k}", "tree") for k in range(levels)]
    ctes.append(f"r0 as (select 0 as tree, tree as pos, digest, (select count(*) from s{levels}) as n from s{levels})")
    ctes += [_level(f"r{k + 1}", f"r{k}", "tree") for k in range(levels)]
    # The path of a leaf: at each level the siblings before and after its node.
    rows, path = "t", []
    for kind, tree in (("s", "tree"), ("r", "0")):
        for k in range(levels):
            at = f"x.pos // {16 ** k}" if kind == "s" else f"x.tree // {16 ** k}"
            for side, sign in (("b", "<"), ("a", ">")):
                path.append(f"(select case when any_value(n) > 1 then string_agg(digest, '' order by pos) filter (pos {sign} {at}) end"
                            f" from {kind}{k} y where y.tree = {'x.tree' if kind == 's' else '0'} and y.pos // 16 = ({at}) // 16)")
    names = [f"{side}{i}" for i in range(2 * levels) for side in ("b", "a")]
    solo = [f"(select any_value(n) = 1 from {kind}{k} y where y.tree = {'x.tree' if kind == 's' else '0'})" for kind in "sr" for k in range(levels)]
    ctes.append("p as (select x.*, " + ", ".join(f"{e} as {c}" for e, c in zip(path, names)) + ", "
                + ", ".join(f"{e} as one{i}" for i, e in enumerate(solo)) + " from t x)")
    fold = "case when crc % 5 = 0 then low else leaf end"
    steps = []
    for i in range(2 * levels):
        steps.append(f"f{i + 1} as (select *, case when one{i} then f{i} else sha256(coalesce(b{i}, '') || f{i} || coalesce(a{i}, '')) end as f{i + 1} from f{i})")
    ctes.append(f"f0 as (select *, {fold} as f0 from p)")
    ctes += steps
    proof = " || ".join(f"coalesce({c}, '')" for c in names)
    return f"""with {', '.join(ctes)}
select x.doc_id, x.leaf, s.digest as subroot, r.digest as root, sha256({proof}) as proof_sha256, x.f{2 * levels} as folded_root,
 x.f{2 * levels} = r.digest as verified
from f{2 * levels} x join s{levels} s on s.tree = x.tree join r{levels} r on r.tree = 0"""


OP12_SQL = _oracle()
