"""UMI tallies and directional UMI clusters.

Rule (directional clustering, Smith, Heger and Sudbery 2017): within one compound, UMI a absorbs b
when they differ in one base and c(a) >= 2 c(b) - 1. UMIs are ranked by (c desc, umi asc); a UMI
roots a cluster unless a lower-ranked one reaches it.

Two facts make that a distributed job with no large group:

* For c(b) >= 2 every absorbing neighbour has a strictly larger count, so b is a root exactly when
  it has no absorbing neighbour: one look at its neighbours decides.
* For c(b) = 1 every neighbour absorbs it, and links among count-1 UMIs run both ways. So a
  connected component of count-1 UMIs has one root, or none if any member touches a larger count.

Neighbours are found by blocking: one mismatch leaves all but one piece of six bases intact, so each
UMI goes to a block per piece (compound, the rest of the UMI), of at most 4^6 UMIs however large the
compound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.components import min_labels
from tagloom.schemas import COMPOUND
from tagloom.session import materialize, sized_broadcast

# Bases masked per block: a block holds at most 4**PIECE distinct UMIs.
PIECE = 6


def tally_outcomes(decoded: DataFrame) -> DataFrame:
    """Reads per (selection, library, outcome, compound, UMI); one shuffle, combined map-side.

    Compound and UMI are null for reads that failed, so those stay a few rows per task. Both the
    UMI tally and the decode statistics derive from this table.
    """
    return decoded.groupBy("selection_id", "library_id", "outcome", "bb_ids", "umi").agg(
        F.count(F.lit(1)).alias("c")
    )


def tally_umis(decoded: DataFrame) -> DataFrame:
    """Valid reads per (selection, library, compound, UMI)."""
    return (
        decoded.filter(F.col("outcome") == "ok")
        .groupBy(*COMPOUND, "umi")
        .agg(F.count(F.lit(1)).alias("c"))
    )


def merge_tallies(tallies: DataFrame) -> DataFrame:
    """Sum partial tallies by key."""
    keys = [c for c in tallies.columns if c in (*COMPOUND, "outcome", "umi")]
    return tallies.groupBy(*keys).agg(F.sum("c").alias("c"))


def rank_umis(tally: DataFrame) -> DataFrame:
    """UMIs with their (c desc, umi asc) sort key; comparable without a sort."""
    return tally.withColumn("umi_rank", F.struct((-F.col("c")).alias("neg_c"), "umi"))


def collect_umis(tally: DataFrame, max_umis: int = 1_000_000) -> DataFrame:
    """One row per compound with its UMI list; an exchange format, nothing computes on it.

    A compound with more than `max_umis` UMIs is spread over several rows, so no row grows without
    bound; the rows together hold all UMIs. The tally is read twice: pass a stored one.
    """
    large = (
        tally.groupBy(*COMPOUND)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > max_umis)
        .select(*COMPOUND, F.ceil(F.col("n") / max_umis).alias("shards"))
    )
    shard = F.pmod(F.xxhash64("umi"), F.coalesce("shards", F.lit(1)))
    return (
        tally.join(sized_broadcast(large), COMPOUND, "left")
        .groupBy(*COMPOUND, shard.alias("shard"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("umi").alias("k"), F.col("c")))).alias("umi_counts"))
        .drop("shard")
    )


def explode_collected(collected: DataFrame) -> DataFrame:
    """The long form of collected compounds."""
    keys = [c for c in COMPOUND if c in collected.columns]
    return collected.select(*keys, F.explode("umi_counts").alias("s")).select(
        *keys, F.col("s.k").alias("umi"), F.col("s.c").alias("c")
    )


def near_umis(tally: DataFrame) -> DataFrame:
    """For every UMI with a neighbour at one mismatch: the lowest-ranked UMI with the same mask.

    One row per UMI and piece is shuffled, to (compound, UMI without the piece). Blocks of one UMI,
    nearly all in sparse data, end there. In the others the piece is masked at each position in turn;
    UMIs with one masked form all differ there only, at most one per base. Both groupings refine the
    partitioning already there, so they need no further shuffle.
    """
    at = F.col("side") * PIECE
    pieces = tally.filter(F.length("umi") > 0).select(
        *COMPOUND,
        "c",
        "umi",
        F.explode(F.sequence(F.lit(0), (F.ceil(F.length("umi") / PIECE) - 1).cast("int"))).alias("side"),
    ).select(
        "*",
        F.concat(F.substr("umi", F.lit(1), at), F.lit("_"), F.substr("umi", at + PIECE + 1)).alias("block"),
        F.substr("umi", at + 1, F.lit(PIECE)).alias("rest"),
    )
    block = [*COMPOUND, "side", "block"]
    crowded = (
        pieces.repartition(*block)
        .groupBy(*block)
        .agg(F.collect_list(F.struct("c", "umi", "rest")).alias("members"))
        .filter(F.size("members") > 1)
    )
    masked = (
        crowded.select(*block, F.explode("members").alias("m"))
        .select(*block, "m.*", F.explode(F.sequence(F.lit(1), F.length("m.rest"))).alias("p"))
        .withColumn(
            "mask",
            F.concat(
                F.substr("rest", F.lit(1), F.col("p") - 1), F.lit("_"), F.substr("rest", F.col("p") + 1)
            ),
        )
    )
    sharing = (
        masked.groupBy(*block, "mask")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("c")).alias("neg_c"), "umi"))).alias("near"))
        .filter(F.size("near") > 1)
    )
    return sharing.select(
        *COMPOUND, F.element_at("near", 1).alias("top"), F.explode("near").alias("one")
    ).select(
        *COMPOUND,
        F.col("one.umi").alias("umi"),
        (-F.col("one.neg_c")).alias("c"),
        F.col("top.umi").alias("top"),
        (-F.col("top.neg_c")).alias("top_c"),
    )


def absorbed_counts(tally: DataFrame, max_group: int = 10_000) -> DataFrame:
    """UMIs per compound that are not cluster roots, as partial sums in `lost`."""
    near = materialize(near_umis(tally), "near-umis")
    by_larger = (
        near.filter((F.col("umi") != F.col("top")) & (F.col("top_c") >= 2))
        .filter((F.col("c") == 1) | (F.col("top_c") >= 2 * F.col("c") - 1))
        .select(*COMPOUND, "umi", "c")
        .distinct()
    )
    by_larger = materialize(by_larger, "absorbed")
    links = near.filter(F.col("top_c") == 1).filter(F.col("umi") != F.col("top"))
    links = links.select(*COMPOUND, F.col("umi").alias("a"), F.col("top").alias("b")).distinct()
    labels = min_labels(links, COMPOUND, max_group)
    # Count-1 UMIs with their component and whether a larger count touches them; one row each.
    ones = labels.select(*COMPOUND, "umi", "label", F.lit(0).alias("touched")).unionByName(
        by_larger.filter(F.col("c") == 1).select(
            *COMPOUND, "umi", F.lit(None).cast("string").alias("label"), F.lit(1).alias("touched")
        )
    )
    ones = ones.groupBy(*COMPOUND, "umi").agg(F.max("label").alias("label"), F.max("touched").alias("touched"))
    # A component is summed up where its members are: a giant one is not gathered.
    components = ones.groupBy(*COMPOUND, F.coalesce("label", "umi").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.max("touched").alias("touched")
    )
    by_link = components.select(*COMPOUND, (F.col("n") - 1 + F.col("touched")).alias("lost"))
    large = by_larger.filter(F.col("c") > 1).select(*COMPOUND, F.lit(1).cast("bigint").alias("lost"))
    return large.unionByName(by_link)


def cluster_umis(tally: DataFrame, max_group: int = 10_000, method: str = "directional") -> DataFrame:
    """Number of UMI clusters per compound as `count`."""
    if method != "directional":
        raise ValueError(f"unknown clustering method {method!r}")
    return count_roots(tally, absorbed_counts(tally, max_group)).select(*COMPOUND, "count")


def count_roots(tally: DataFrame, absorbed: DataFrame) -> DataFrame:
    """Raw, distinct and clustered counts in one grouping: absorbed UMIs enter with a minus."""
    none = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    umis = tally.select(*COMPOUND, F.col("c").alias("raw"), one.alias("one"), one.alias("root"))
    lost = absorbed.select(*COMPOUND, none.alias("raw"), none.alias("one"), (-F.col("lost")).alias("root"))
    return (
        umis.unionByName(lost)
        .groupBy(*COMPOUND)
        .agg(
            F.sum("root").alias("count"),
            F.sum("raw").alias("raw_count"),
            F.sum("one").alias("dedup_count"),
        )
    )
