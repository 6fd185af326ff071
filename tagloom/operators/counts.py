"""Compound counts: from tallies, unions, deduplication, n-synthons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.umi import absorbed_counts, count_roots
from tagloom.schemas import COMPOUND, COUNTS

MEASURES = ["count", "raw_count", "dedup_count"]


def raw_counts(tally: DataFrame) -> DataFrame:
    return tally.groupBy(*COMPOUND).agg(F.sum("c").alias("raw_count"))


def dedup_counts(tally: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct UMIs per compound; a tally has one row per UMI, so they are counted, not compared."""
    n = F.approx_count_distinct("umi") if approx else F.count(F.lit(1))
    return tally.groupBy(*COMPOUND).agg(n.alias("dedup_count"))


def count_compounds(
    tally: DataFrame,
    cluster: bool = True,
    keep_raw: bool = True,
    keep_dedup: bool = True,
    max_group: int = 10_000,
) -> DataFrame:
    """Counts per compound. `count` is the number of UMI clusters, or of UMIs without clustering.

    The tally is read more than once: pass a stored one.
    """
    if cluster:
        counts = count_roots(tally, absorbed_counts(tally, max_group))
    else:
        counts = tally.groupBy(*COMPOUND).agg(
            F.count(F.lit(1)).alias("count"),
            F.sum("c").alias("raw_count"),
            F.count(F.lit(1)).alias("dedup_count"),
        )
    kept = ["count"] + ["raw_count"] * keep_raw + ["dedup_count"] * keep_dedup
    return counts.select(*COMPOUND, *kept)


def union_counts(*parts: DataFrame) -> DataFrame:
    """All rows of several count tables; columns a table lacks become null."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def deduplicate(counts: DataFrame, drop_exact: bool = False) -> DataFrame:
    """One row per compound, counts summed. `drop_exact` first removes repeated rows, as left by a
    file delivered twice."""
    keys = [c for c in COMPOUND if c in counts.columns]
    measures = [c for c in MEASURES if c in counts.columns]
    if drop_exact:
        counts = counts.dropDuplicates([*keys, *measures])
    return counts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in measures])


def synthon_counts(counts: DataFrame, max_size: int | None = None) -> DataFrame:
    """Counts of every n-synthon: each non-empty subset of cycles, compounds summed over the rest.

    `cycles` names the subset ("1,3") and `synthon` its building blocks in that order. Subsets follow each compound's own
    number of cycles; `max_size` leaves out larger ones. Each row is expanded to its subsets and combined map-side.
    """
    measures = [c for c in MEASURES if c in counts.columns]
    compounds = deduplicate(counts).withColumn("bb", F.split("bb_ids", ","))
    # Subset number m holds cycle i + 1 if bit i of m is set.
    numbers = F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), F.size("bb")) - 1)
    if max_size is not None:
        numbers = F.filter(numbers, lambda m: F.bit_count(m) <= max_size)
    picked = F.transform(numbers, lambda m: F.filter(F.sequence(F.lit(1), F.size("bb")), lambda i: F.getbit(m, i - 1) == 1))
    subsets = F.transform(
        picked,
        lambda s: F.struct(
            F.array_join(s.cast("array<string>"), ",").alias("cycles"),
            F.array_join(F.transform(s, lambda i: F.element_at("bb", i)), ",").alias("synthon"),
        ),
    )
    expanded = compounds.filter(F.length("bb_ids") > 0).select("selection_id", "library_id", *measures, F.explode(subsets).alias("s"))
    return expanded.groupBy("selection_id", "library_id", "s.cycles", "s.synthon").agg(
        F.count(F.lit(1)).alias("n_compounds"), *[F.sum(c).alias(c) for c in measures]
    )


__all__ = [
    "COUNTS",
    "count_compounds",
    "deduplicate",
    "dedup_counts",
    "raw_counts",
    "synthon_counts",
    "union_counts",
]
