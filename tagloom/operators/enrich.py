"""Enrichment of compounds and n-synthons.

With N counts in a (selection, library), D possible members and p0 = 1/D, a member seen k times has
p = k/N, fold p/p0 and normalized z-score (p - p0)/sqrt(p0(1 - p0)) with an Agresti-Coull interval
(Faver et al. 2019).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.ids import bb_array
from tagloom.operators.places import running_sums
from tagloom.session import LOOKUP_SALTS, is_small, materialize, sized_broadcast

LIBRARY = ["selection_id", "library_id"]
# Spark limits a window's groups in each task below this many rows; a window beyond it would sort a library in one task.
WINDOW_LIMIT = 1000


def attach_building_blocks(counts: DataFrame, building_blocks: DataFrame, n_cycles: int) -> DataFrame:
    """Add the tag of each cycle's building block (tag1..tagN); unknown ids stay null."""
    out = counts.withColumn("bb", bb_array("bb_ids"))
    for cycle in range(1, n_cycles + 1):
        side = building_blocks.filter(F.col("cycle") == cycle).select(
            F.col("library_id").alias("__lib"),
            F.col("id").alias("__id"),
            F.col("tag").alias(f"tag{cycle}"),
        )
        same = (F.col("library_id") == F.col("__lib")) & (F.col("bb")[cycle - 1] == F.col("__id"))
        out = out.join(sized_broadcast(side), same, "left").drop("__lib", "__id")
    return out.drop("bb")


def observed_blocks(counts: DataFrame) -> DataFrame:
    """Distinct (library, cycle, id) in the counts; combined map-side to the size of the definitions."""
    return (
        counts.select("library_id", F.posexplode(bb_array("bb_ids")).alias("at", "id"))
        .select("library_id", (F.col("at") + 1).alias("cycle"), "id")
        .distinct()
    )


def unknown_building_blocks(counts: DataFrame, building_blocks: DataFrame) -> DataFrame:
    """Counted ids that the definitions do not hold."""
    keys = ["library_id", "cycle", "id"]
    return observed_blocks(counts).join(building_blocks.select(*keys), keys, "left_anti")


def unused_building_blocks(counts: DataFrame, building_blocks: DataFrame) -> DataFrame:
    """Defined ids that no compound holds."""
    keys = ["library_id", "cycle", "id"]
    return building_blocks.select(*keys).distinct().join(observed_blocks(counts), keys, "left_anti")


def library_diversity(building_blocks: DataFrame, cycles: list[int] | None = None) -> DataFrame:
    """Possible members D per library: product over cycles of the number of building blocks."""
    if cycles is not None:
        building_blocks = building_blocks.filter(F.col("cycle").isin(cycles))
    per_cycle = building_blocks.groupBy("library_id", "cycle").agg(F.countDistinct("id").alias("n"))
    product = F.aggregate("n", F.lit(1.0), lambda acc, n: acc * n)
    return (
        per_cycle.groupBy("library_id")
        .agg(F.collect_list("n").alias("n"))
        .select("library_id", product.alias("diversity"))
    )


def join_total(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Add `total`, the counts of the row's (selection, library) in `counts`; a null selection is one like any other.

    Totals are a row per (selection, library), joined back by broadcast: a window would gather a
    whole library in one task.
    """
    totals = counts.groupBy(*[F.col(c).alias(f"__{c}") for c in LIBRARY]).agg(F.sum("count").alias("total"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in LIBRARY]
    return rows.join(sized_broadcast(totals), same).drop(*[f"__{c}" for c in LIBRARY])


def with_library_total(counts: DataFrame) -> DataFrame:
    return join_total(counts, counts)


def _scores(z: float) -> dict[str, Column]:
    k, n, p0 = F.col("count"), F.col("total"), F.lit(1.0) / F.col("diversity")
    spread = F.sqrt(p0 * (F.lit(1.0) - p0))
    p = k / n
    n_adj = n + F.lit(z * z)
    p_adj = (k + F.lit(z * z / 2)) / n_adj
    half = F.lit(z) * F.sqrt(p_adj * (F.lit(1.0) - p_adj) / n_adj)
    # One possible member has no spread; its z-score is undefined.
    score = lambda share: F.when(spread > 0, (share - p0) / spread)
    return {
        "fold": p / p0,
        "z_n": score(p),
        "z_low": score(p_adj - half),
        "z_high": score(p_adj + half),
    }


def enrichment(counts: DataFrame, building_blocks: DataFrame, z: float = 1.96) -> DataFrame:
    """Scores per compound."""
    diversity = sized_broadcast(library_diversity(building_blocks))
    return with_library_total(counts).join(diversity, "library_id", "left").withColumns(_scores(z))


def synthon_enrichment(
    synthons: DataFrame, counts: DataFrame, building_blocks: DataFrame, z: float = 1.96
) -> DataFrame:
    """Scores per n-synthon; D counts the synthon's own cycles only."""
    subsets = [
        [int(c) for c in row.cycles.split(",")] for row in synthons.select("cycles").distinct().collect()
    ]
    parts = [
        library_diversity(building_blocks, cycles).withColumn("cycles", F.lit(",".join(map(str, cycles))))
        for cycles in subsets
    ]
    diversity = parts[0]
    for part in parts[1:]:
        diversity = diversity.unionByName(part)
    return (
        join_total(synthons, counts)
        .join(sized_broadcast(diversity), ["library_id", "cycles"], "left")
        .withColumns(_scores(z))
    )


def contrast(counts: DataFrame, target_id: str, control_id: str, pseudo: float = 1.0) -> DataFrame:
    """Ratio of target to control shares per compound; a compound missing on one side counts zero.

    One conditional grouping stands for the full outer join of the two selections.
    """
    side = lambda name: F.when(F.col("selection_id") == name, F.col("count")).otherwise(0)
    both = counts.filter(F.col("selection_id").isin(target_id, control_id))
    sums = [F.sum(side(target_id)).alias("k_target"), F.sum(side(control_id)).alias("k_control")]
    compounds = both.groupBy("library_id", "bb_ids").agg(*sums)
    totals = both.groupBy("library_id").agg(
        F.sum(side(target_id)).alias("n_target"), F.sum(side(control_id)).alias("n_control")
    )
    share = lambda k, n: (F.col(k) + pseudo) / (F.col(n) + pseudo)
    return compounds.join(sized_broadcast(totals), "library_id").withColumn(
        "ratio", share("k_target", "n_target") / share("k_control", "n_control")
    )


def score_ranks(scores: DataFrame, by: str) -> DataFrame:
    """(selection, library, score) with `before`, the rows of a better score in the library, `total`, all of them, and `n`."""
    per_score = scores.groupBy(*LIBRARY, by).agg(F.count(F.lit(1)).alias("n"))
    ranks = running_sums(per_score, LIBRARY, [F.col(by).desc_nulls_last()], "n")
    return materialize(ranks.withColumnsRenamed({"before__": "before", "total__": "total"}), "score-ranks")


def rank_enrichment(scores: DataFrame, by: str = "z_n") -> DataFrame:
    """Add `rank` and `percent_rank` by descending score within each (selection, library).

    Scores repeat (they follow small integer counts), so the ranks are worked out on the distinct
    scores and joined back: a hot library is never sorted in one task. The scores are stored first, so both
    sides of the join hold the same bits.
    """
    scores = materialize(scores, "scores")
    ranks = score_ranks(scores, by).select(
        *[F.col(c).alias(f"__{c}") for c in LIBRARY],
        F.col(by).alias("__by"),
        (F.col("before") + 1).alias("rank"),
        F.col("total").alias("__all"),
    )
    same = [F.col(f"__{c}").eqNullSafe(F.col(c)) for c in LIBRARY] + [F.col("__by").eqNullSafe(F.col(by))]
    if is_small(ranks):
        joined = scores.join(F.broadcast(ranks), same)
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_SALTS - 1)))
        salt = F.pmod(F.xxhash64("bb_ids"), F.lit(LOOKUP_SALTS)).cast("int")
        joined = scores.withColumn("__salt", salt).join(
            ranks.withColumn("__s", salts), [*same, F.col("__salt") == F.col("__s")]
        )
    percent = F.when(F.col("__all") > 1, (F.col("rank") - 1) / (F.col("__all") - 1)).otherwise(0.0)
    return joined.select(*scores.columns, "rank", percent.alias("percent_rank"))


def top_enriched(scores: DataFrame, k: int, per_library: bool = True, by: str = "z_n") -> DataFrame:
    """The k best, ties broken by key. Spark keeps k per task before the shuffle, up to WINDOW_LIMIT per library.

    For more, the scores of each library are counted, the score of the k-th row is read off the running counts, and only
    rows at least as good are put in order, by ranges.
    """
    key = "bb_ids" if "bb_ids" in scores.columns else "synthon"
    order = [F.desc_nulls_last(by), F.asc(key)]
    if not per_library:
        return scores.orderBy(*order, "selection_id", "library_id").limit(k)
    if k < WINDOW_LIMIT:
        place = F.row_number().over(Window.partitionBy(*LIBRARY).orderBy(*order))
        return scores.withColumn("place", place).filter(F.col("place") <= k)
    scores = materialize(scores, "scores")
    last = score_ranks(scores, by).filter(F.col("before") < k).groupBy(*[F.col(c).alias(f"__{c}") for c in LIBRARY])
    cuts = last.agg(F.min(by).alias("__cut"), F.max(F.col(by).isNull()).alias("__nulls"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in LIBRARY]
    enough = F.col("__nulls") | (F.col(by) >= F.col("__cut"))
    best = scores.join(sized_broadcast(cuts), [*same, enough]).select(*scores.columns)
    ranked = running_sums(best, LIBRARY, order)
    return ranked.filter(F.col("before__") < k).select(*scores.columns, (F.col("before__") + 1).cast("int").alias("place"))
