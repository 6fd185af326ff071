"""Merkle manifest of a dataset: stored node rows linked to their parents, and a recursive query that climbs from each leaf.

Leaves hang under one tree per source, the roots of those under one tree more. Every node joins up to FANOUT children.
A stored row is a node, the siblings beside it on the next BAND levels, and the link to the node it ends at there. The
levels of a band are made together, in the group of the at most FANOUT ** BAND nodes that share that end: no group grows
with the data. Places in a source come from counts per partition, never from a window over its rows. Upper nodes, on
which many climbs meet, are stored in copies when they are too many to broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.session import is_small, materialize

FANOUT = 3
BAND = 6
# The tree of the sources' roots; a source's own tree has its place among the sources, from 0 on.
TOP = -1
# Nodes that are broadcast, by counted rows (each below 2 KB), and leaves below a node for each stored copy of it beyond that.
BROADCAST_NODES = 100_000
LEAVES_PER_COPY = 100_000
LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
ROW_LIMIT, LEVEL_LIMIT = "spark.sql.cteRecursionRowLimit", "spark.sql.cteRecursionLevelLimit"


def encoded_field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def without_lines(key: str, text: str) -> Column:
    """The text without its line feeds where 2 divides the CRC-32 of the key in decimal; a null key leaves it as it is."""
    chosen = F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 0
    return F.when(chosen, F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Add `place`, from 0 on within each group in the given order (nulls first), the group's rows `n`, and its own place `ordinal`.

    Rows are dealt by ranges of group and order; counts per partition and group give the offsets. A window sees one row for
    each partition that a group reaches into; without a group, one row a partition.
    """
    by = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    local = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    local = materialize(local.withColumns({"part__": F.spark_partition_id(), "at__": F.monotonically_increasing_id()}), "ordered")
    pieces = materialize(local.groupBy(*group, "part__").agg(F.min("at__").alias("from__"), F.count(F.lit(1)).alias("m__")), "pieces")
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    before = whole.orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("m__").over(before), F.lit(0)) - F.col("from__")
    offsets = pieces.select(*group, "part__", offset.alias("offset__"), F.sum("m__").over(whole).alias("n"))
    if group:
        ordinals = numbered(pieces.select(*group).distinct(), [], group).select(*[F.col(c).alias(f"{c}__") for c in group], F.col("place").alias("ordinal"))
        offsets = offsets.join(ordinals, [F.col(c).eqNullSafe(F.col(f"{c}__")) for c in group]).drop(*[f"{c}__" for c in group])
    else:
        offsets = offsets.withColumn("ordinal", F.lit(0).cast("bigint"))
    offsets = materialize(offsets.withColumnsRenamed({c: f"{c}__own" for c in [*group, "part__"]}), "offsets")
    same = [F.col(c).eqNullSafe(F.col(f"{c}__own")) for c in group] + [F.col("part__") == F.col("part____own")]
    joined = local.join(F.broadcast(offsets) if is_small(offsets) else offsets, same)
    return joined.select(*rows.columns, (F.col("at__") + F.col("offset__")).alias("place"), "n", "ordinal")


def levels_above(n: Column, fanout: int) -> Column:
    """Levels until one node is left, exact for any bigint."""
    powers = F.array(*[F.lit(fanout**e).cast("bigint") for e in range(64) if fanout**e < 1 << 63])
    return F.size(F.filter(powers, lambda p: p < n))


def div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def joined_runs(level: Column, fanout: int) -> Column:
    """The level above a level of digests."""
    runs = F.sequence(F.lit(0), div(F.size(level) - 1, fanout).cast("int"))
    return F.transform(runs, lambda r: digest(F.array_join(F.slice(level, r * fanout + 1, F.lit(fanout)), "")))


def copies_of(weight: Column) -> Column:
    return F.ceil(weight / F.lit(LEAVES_PER_COPY)).cast("int")


def stored_bands(leaves: DataFrame, fanout: int, band: int) -> list[DataFrame]:
    """The stored nodes of all trees, a table for each step of `band` levels.

    Leaves are (tree, place, n, digest, weight, payload): `n` the leaves of the tree, `weight` what counts below one. A node
    has, besides, `path` (level by level the digests before and after it in its run), `parent` (the place in the next step
    of the node it ends at), `top` (that node's digest), `last` (it is the root), `total` (its weight).
    """
    above = leaves.select("tree", "place", "digest", "weight", "payload", levels_above(F.col("n"), fanout).alias("left"))
    steps = []
    while True:
        group = div(F.col("place"), fanout**band)
        members = F.sort_array(F.collect_list(F.struct("place", "digest", "weight", "payload")))
        rows = above.groupBy("tree", group.alias("parent"), "left").agg(members.alias("members"), F.sum("weight").alias("total"))
        rows = rows.withColumn("d0", F.transform("members", lambda m: m["digest"]))
        for level in range(1, band + 1):
            below = F.col(f"d{level - 1}")
            rows = rows.withColumn(f"d{level}", F.when(F.col("left") >= level, joined_runs(below, fanout)).otherwise(below))

        def beside(at: Column, level: int) -> Column:
            place = div(at, fanout**level).cast("int")
            inside, side = place % fanout, F.col(f"d{level}")
            before = F.array_join(F.slice(side, place - inside + 1, inside), "")
            after = F.array_join(F.slice(side, place + 2, fanout - 1 - inside), "")
            return F.when(F.col("left") > level, F.struct(before.alias("before"), after.alias("after")))

        def node(m: Column, i: Column) -> Column:
            path = F.filter(F.array(*[beside(i, level) for level in range(band)]), lambda x: x.isNotNull())
            return F.struct(m["place"].alias("place"), m["digest"].alias("digest"), m["payload"].alias("payload"), path.alias("path"))

        made = rows.select("tree", "parent", "left", "total", F.element_at(f"d{band}", 1).alias("top"), F.transform("members", node).alias("nodes"))
        made = materialize(made, "band")
        last = F.col("left") <= band
        steps.append(made.select("tree", "parent", "total", "top", last.alias("last"), F.explode("nodes").alias("m")).select("tree", "parent", "total", "top", "last", "m.*"))
        above = made.filter(~last).select(
            "tree", F.col("parent").alias("place"), F.col("top").alias("digest"), F.col("total").alias("weight"),
            F.lit(None).cast(leaves.schema["payload"].dataType).alias("payload"), (F.col("left") - band).alias("left"),
        )
        if above.isEmpty():
            return steps


def build(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: list[str] | None = None, payload: Column | None = None, fanout: int = FANOUT, band: int = BAND):
    """(leaves, nodes, steps): the leaf rows and the inner node rows of a manifest, linked to their parents.

    A leaf's digest covers `fields`, in order. Leaves of one group ascend by key, nulls first, ties by digest. `payload`
    (any struct) travels with the leaf. Each node links to (to_tree, to_step, to_place), of which `to_copies` are stored.
    """
    fields = fields or LEAF_FIELDS
    payload = F.struct(F.lit(0).alias("none")) if payload is None else payload
    leaf = digest(*[encoded_field(F.col(f)) for f in fields])
    rows = docs.select(F.col(group).alias("group"), F.col(key).alias("key"), leaf.alias("digest"), payload.alias("payload"))
    rows = rows.select("group", "key", "digest", F.struct("key", F.col("payload").alias("own")).alias("payload"))
    placed = numbered(rows, ["group"], ["key", "digest"])
    one = F.lit(1).cast("bigint").alias("weight")
    lower = stored_bands(placed.select(F.col("ordinal").alias("tree"), "place", "n", "digest", one, "payload"), fanout, band)
    roots = [step.filter(F.col("last")).select("tree", "top", "total").distinct() for step in lower]
    tops = roots[0]
    for more in roots[1:]:
        tops = tops.unionByName(more)
    n = tops.count()
    none = F.lit(None).cast("int").alias("payload")
    forest = tops.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("place"), F.lit(n).cast("bigint").alias("n"), F.col("top").alias("digest"), F.col("total").alias("weight"), none)
    upper = stored_bands(forest, fanout, band)

    def linked(step: DataFrame, number: int, inner: bool) -> DataFrame:
        """`inner`: in the tree over the sources' roots, whose root is the end; else the last band leads into that tree."""
        last = F.col("last")
        return step.select(
            "tree", F.lit(number).alias("step"), "place", "digest", "path", "payload",
            F.when(last, F.lit(TOP)).otherwise(F.col("tree")).cast("bigint").alias("to_tree"),
            F.when(last, F.lit(-1 if inner else 0)).otherwise(number + 1).alias("to_step"),
            F.when(last & F.lit(not inner), F.col("tree")).otherwise(F.col("parent")).alias("to_place"),
            F.greatest(copies_of(F.col("total")), F.lit(1)).alias("to_copies"),
            F.when(last & F.lit(not inner), F.col("top")).alias("subroot"),
            F.when(last & F.lit(inner), F.col("top")).alias("root"),
        )

    leaves = linked(lower[0], 0, False)
    parts = [linked(s, i, False) for i, s in enumerate(lower) if i] + [linked(s, i, True) for i, s in enumerate(upper)]
    nodes = parts[0].drop("payload")
    for part in parts[1:]:
        nodes = nodes.unionByName(part.drop("payload"))
    return leaves, materialize(nodes, "nodes"), len(lower) + len(upper)


@contextmanager
def deep_recursion(spark: SparkSession, rounds: int) -> Iterator[None]:
    """Recursive queries may make any number of rows, and as many rounds as there are steps."""
    old = {name: spark.conf.get(name, None) for name in (ROW_LIMIT, LEVEL_LIMIT)}
    spark.conf.set(ROW_LIMIT, "-1")
    spark.conf.set(LEVEL_LIMIT, str(max(100, rounds + 10)))
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# One row a leaf in each round: where it stands, the digest folded so far from `start`, and the siblings met.
CLIMB = """
WITH RECURSIVE climb(key, leaf, tree, step, place, copy, at, folded, proof, subroot, root) AS (
  SELECT l.payload.key, l.digest, l.to_tree, l.to_step, l.to_place, CAST(l.place % l.to_copies AS INT), l.place,
    aggregate(l.path, l.start, (h, s) -> sha2(concat(s.before, h, s.after), 256)),
    unhex(array_join(transform(l.path, s -> concat(s.before, s.after)), '')), l.subroot, l.root
  FROM {leaves} l
  UNION ALL
  SELECT c.key, c.leaf, n.to_tree, n.to_step, n.to_place, CAST(c.at % n.to_copies AS INT), c.at,
    aggregate(n.path, c.folded, (h, s) -> sha2(concat(s.before, h, s.after), 256)),
    concat(c.proof, unhex(array_join(transform(n.path, s -> concat(s.before, s.after)), ''))), coalesce(c.subroot, n.subroot), n.root
  FROM climb c JOIN {nodes} n ON c.tree = n.tree AND c.step = n.step AND c.place = n.place AND c.copy = n.copy
  WHERE c.root IS NULL
)
SELECT key, leaf, subroot, root, sha2(lower(hex(proof)), 256) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM climb WHERE root IS NOT NULL
"""


def climb(leaves: DataFrame, nodes: DataFrame, start: Column, rounds: int) -> DataFrame:
    """For each leaf: key, leaf, subroot, root, proof_sha256 (its siblings, level by level), folded_root and verified.

    `start`, a column of `leaves`, is the digest that is folded upwards with the stored siblings.
    """
    spark = leaves.sparkSession
    if is_small(nodes, BROADCAST_NODES):
        # A node has as many copies as climbs may ask for; here one row answers for all of them.
        many = F.broadcast(nodes.withColumn("copy", F.lit(0)).withColumn("to_copies", F.lit(1)))
        leaves = leaves.withColumn("to_copies", F.lit(1))
    else:
        stored = nodes.select("to_tree", "to_step", "to_place", "to_copies").unionByName(leaves.select("to_tree", "to_step", "to_place", "to_copies")).filter("to_step >= 0").distinct()
        address = [F.col("tree") == F.col("own_tree"), F.col("step") == F.col("own_step"), F.col("place") == F.col("own_place")]
        own = stored.select(F.col("to_tree").alias("own_tree"), F.col("to_step").alias("own_step"), F.col("to_place").alias("own_place"), F.col("to_copies").alias("copies"))
        many = nodes.join(own, address).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("own_tree", "own_step", "own_place", "copies")
    with deep_recursion(spark, rounds):
        return materialize(spark.sql(CLIMB, leaves=leaves.withColumn("start", start), nodes=many), "climbed")


def verify_tampered(docs: DataFrame, key: str = "doc_id", group: str = "source", text: str = "text", fields: list[str] | None = None, fanout: int = FANOUT, band: int = BAND) -> DataFrame:
    """One row per document: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    All digests are of the documents as given, but `folded_root`, which starts from the tampered document: its line feeds
    deleted where 2 divides the CRC-32 of the key. Null fields count as `-`; a null key is never tampered with and stands
    first, a null group is a group of its own, the first. Repeated keys are leaves of their own, by digest; equal rows
    give rows that differ in their proofs. Columns outside `fields` are ignored. An empty table gives an empty table.
    """
    fields = fields or [key, group, "lang", "n_chars", text]
    changed = without_lines(key, text)
    tampered = digest(*[encoded_field(changed if f == text else F.col(f)) for f in fields])
    leaves, nodes, rounds = build(docs, key, group, fields, F.struct(tampered.alias("tampered")), fanout, band)
    return climb(leaves, nodes, F.col("payload.own.tampered"), rounds).withColumnRenamed("key", key)
