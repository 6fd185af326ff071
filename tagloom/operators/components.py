"""Connected components of links inside groups, labelled by the smallest member.

Links are thinned where they lie: a task joins its links in a forest and passes on one link for each node but the roots. What
one task can hold is settled by that; the rest goes through rounds of stars, in which nodes of high degree are not shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.session import materialize

# Ship this module's functions inside the task, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GROUPS_TO_BROADCAST = 1_000_000
MAX_ROUNDS = 60
# Links that a forest holds before it is passed on; bounds a task's memory.
FOREST_LINKS = 250_000
# Nodes with more neighbours than this, and than one in HUB_SHARE of all links, get their minimum by broadcast: at most 2 * HUB_SHARE rows.
HUB_DEGREE = 10_000
HUB_SHARE = 100_000

_LABELS = T.ArrayType(
    T.StructType([T.StructField("umi", T.StringType()), T.StructField("label", T.StringType())])
)


def _label_group(links) -> list[dict]:
    root: dict[str, str] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for link in links:
        low, high = sorted((find(link["a"]), find(link["b"])))
        root[high] = low
    return [{"umi": x, "label": find(x)} for x in root]


def labels_of_small_groups(links: DataFrame, group: list[str]) -> DataFrame:
    """One bounded array of links per group, solved in Arrow batches."""

    @F.pandas_udf(_LABELS)
    def solve(groups: pd.Series) -> pd.Series:
        return groups.map(_label_group)

    return (
        links.groupBy(*group)
        .agg(F.collect_list(F.struct("a", "b")).alias("links"))
        .select(*group, F.explode(solve("links")).alias("s"))
        .select(*group, "s.*")
    )


def forests(links: DataFrame, group: list[str], size: int) -> DataFrame:
    """The same components with fewer links: of each run of `size` links in a task, every node but the smallest of its tree, and that smallest one."""
    names = [*group, "a", "b"]

    def passed_on(root: dict) -> pa.RecordBatch:
        rows = [(*x, _top(root, x)[-1]) for x in list(root) if root[x] != x]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names=names)

    kinds: list[pa.DataType] = []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict = {}
        held = 0
        for batch in batches:
            kinds[:] = batch.schema.types
            columns = [c.to_pylist() for c in batch.columns]
            own = list(zip(*columns[:-2])) if group else [()] * batch.num_rows
            for g, a, b in zip(own, columns[-2], columns[-1]):
                x, y = _top(root, (*g, a)), _top(root, (*g, b))
                if x != y:
                    low, high = (x, y) if x[-1] < y[-1] else (y, x)
                    root[high] = low
            held += batch.num_rows
            if held >= size:
                yield passed_on(root)
                root, held = {}, 0
        if root:
            yield passed_on(root)

    return links.select(*names).mapInArrow(work, links.select(*names).schema)


def _top(root: dict, x: tuple) -> tuple:
    while root.setdefault(x, x) != x:
        root[x] = root[root[x]]
        x = root[x]
    return x


def labels_of_large_groups(links: DataFrame, group: list[str], size: int | None = None) -> DataFrame:
    """Forests of the links, then alternating large-star and small-star rounds (Kiveris et al. 2014) until nothing changes.

    Rounds grow with the logarithm of the component size. Each is a grouping by (group, node), with
    a written table as the cut. The stars connect only to the minimum of a node's neighbours, which
    is joined back rather than collected: no neighbour list is ever held in memory.
    """
    size = size or FOREST_LINKS
    now = materialize(links.select(*group, "a", "b").filter(F.col("a") != F.col("b")), "links")
    tasks = max(1, -(-now.count() // size))
    # The tasks are fewer, not the links: a task that gets more than `size` links passes them on in several forests.
    now = materialize(forests(now.coalesce(tasks), group, size).distinct(), "forests")
    for _ in range(0 if tasks == 1 else MAX_ROUNDS):
        n = now.count()
        hub = max(HUB_DEGREE, n // HUB_SHARE)
        large = materialize(_star(now, group, True, hub), "stars")
        after = materialize(_star(large, group, False, hub), "links")
        # Both are sets: of one size, they differ only if one holds a link the other lacks.
        same = after.count() == n and after.subtract(now).isEmpty()
        now = after
        if same:
            break
    else:
        if tasks > 1:
            raise RuntimeError("components did not settle")
    centres = now.select(*group, F.col("b").alias("umi"), F.col("b").alias("label")).distinct()
    return now.select(*group, F.col("a").alias("umi"), F.col("b").alias("label")).unionByName(centres)


def _star(links: DataFrame, group: list[str], large: bool, hub: int) -> DataFrame:
    """Links run from the larger node `a` to the smaller `b`.

    Large star: every larger neighbour of a node goes to the node's minimum. Small star: every
    smaller neighbour, and the node itself, goes there.
    """
    if large:
        around = links.select(*group, F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(*group, F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        around = links.select(*group, F.col("a").alias("u"), F.col("b").alias("v"))
    least = around.groupBy(*group, "u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    least = materialize(least.withColumn("m", F.least("m", "u")), "least")
    joined = with_least(around, least, group, hub)
    if large:
        moved = joined.filter(F.col("v") > F.col("u")).select(*group, F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = (
            joined.filter(F.col("v") != F.col("m"))
            .select(*group, F.col("v").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select(*group, F.col("u").alias("a"), F.col("m").alias("b")))
        )
    return moved.filter(F.col("a") != F.col("b")).distinct()


def with_least(around: DataFrame, least: DataFrame, group: list[str], hub: int) -> DataFrame:
    """Each (u, v) with the minimum of u; a null group is one like any other. Rows of nodes with more than `hub` neighbours stay where they are."""
    key = [*group, "u"]
    side = least.withColumnsRenamed({c: f"{c}__" for c in key})
    same = [F.col(c).eqNullSafe(F.col(f"{c}__")) for c in group] + [F.col("u") == F.col("u__")]
    columns = [*around.columns, "m"]
    hubs = materialize(side.filter(F.col("n") > hub), "hubs")
    if hubs.isEmpty():
        return around.join(side, same).select(*columns)
    near = around.join(F.broadcast(hubs), same, "left_anti")
    return around.join(F.broadcast(hubs), same).select(*columns).unionByName(near.join(side.filter(F.col("n") <= hub), same).select(*columns))


def min_labels(links: DataFrame, group: list[str], max_group: int) -> DataFrame:
    """(group, umi, label) for every linked node; groups past `max_group` links are solved in rounds."""
    links = materialize(links, "links")
    sizes = links.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_group)
    large = materialize(sizes.select(*group), "large-groups")
    n = large.count()
    if n == 0:
        return labels_of_small_groups(links, group)
    if n > GROUPS_TO_BROADCAST:
        return labels_of_large_groups(links, group)
    is_large = F.broadcast(large)
    few = links.join(is_large, group, "left_anti")
    many = links.join(is_large, group, "left_semi")
    return labels_of_small_groups(few, group).unionByName(labels_of_large_groups(many, group))
