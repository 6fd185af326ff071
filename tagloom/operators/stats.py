"""Decode statistics, run summary and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.decode import outcome_names


def decode_stats(decoded: DataFrame) -> DataFrame:
    """Reads per (selection, library, outcome), from decoded reads or from their outcome tally."""
    n = F.sum("c") if "c" in decoded.columns else F.count(F.lit(1))
    return decoded.groupBy("selection_id", "library_id", "outcome").agg(n.alias("n"))


def with_total_level(per_library: DataFrame) -> DataFrame:
    """Each row once for its library and once for the total over libraries."""
    level = F.explode(
        F.array(
            F.struct(F.lit("library").alias("level"), F.col("library_id").alias("library_id")),
            F.struct(F.lit("total").alias("level"), F.lit(None).cast("string").alias("library_id")),
        )
    )
    others = [c for c in per_library.columns if c != "library_id"]
    return per_library.select(*others, level.alias("s")).select(*others, "s.level", "s.library_id")


def merge_stats(stats: DataFrame) -> DataFrame:
    """Sum partial statistics and add a row per (selection, outcome) over all libraries.

    `level` is 'library' or 'total': a read without a library also has a null library_id.
    """
    keys = ["selection_id", "outcome"]
    per_library = stats.groupBy(*keys, "library_id").agg(F.sum("n").alias("n"))
    return (
        with_total_level(per_library)
        .groupBy(*keys, "level", "library_id")
        .agg(F.sum("n").alias("n"))
        .select("selection_id", "level", "library_id", "outcome", "n")
    )


def count_summary(counts: DataFrame) -> DataFrame:
    """Compounds and count totals per (selection, library)."""
    return counts.groupBy("selection_id", "library_id").agg(
        F.count(F.lit(1)).alias("compounds"),
        F.sum("raw_count").alias("raw_count"),
        F.sum("dedup_count").alias("dedup_count"),
        F.sum("count").alias("count"),
    )


def known_outcomes(stats: DataFrame, n_cycles: int | None) -> list[str]:
    """Outcomes of this many cycles; with None, also those of any further cycle and any other that `stats` holds.

    Statistics are a few rows per (selection, library): pass stored ones with None.
    """
    if n_cycles is not None:
        return outcome_names(n_cycles)
    names = outcome_names(3)
    found = sorted(r.outcome for r in stats.select("outcome").distinct().collect())
    return names + [o for o in found if o not in names]


def outcome_columns(stats: DataFrame, n_cycles: int | None) -> DataFrame:
    """Statistics with one column per outcome. A given `n_cycles` says which, so nothing is scanned for them."""
    return _outcome_columns(stats, known_outcomes(stats, n_cycles))


def _outcome_columns(stats: DataFrame, outcomes: list[str]) -> DataFrame:
    return (
        stats.groupBy("selection_id", "library_id")
        .pivot("outcome", outcomes)
        .agg(F.sum("n"))
        .na.fill(0)
    )


def join_summary(stats: DataFrame, summary: DataFrame, outcomes: list[str]) -> DataFrame:
    """Statistics and count totals side by side; either side may lack a library.

    Both are a row per (selection, library). Reads without a library have no counts to meet, so the
    null key needs no match.
    """
    wide = _outcome_columns(stats, outcomes)
    return wide.join(summary, ["selection_id", "library_id"], "full_outer")


def decode_summary(counts: DataFrame, stats: DataFrame, n_cycles: int | None = 3) -> DataFrame:
    """Per library and in total: compounds, counts, reads by outcome, reads per distinct UMI."""
    outcomes = known_outcomes(stats, n_cycles)
    numbers = ["compounds", "raw_count", "dedup_count", "count", *outcomes]
    joined = join_summary(stats, count_summary(counts), outcomes)
    rolled = (
        with_total_level(joined)
        .groupBy("selection_id", "level", "library_id")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in numbers])
    )
    reads = sum((F.col(o) for o in outcomes[1:]), F.col(outcomes[0]))
    return rolled.select(
        "selection_id",
        "level",
        "library_id",
        *numbers,
        reads.alias("reads"),
        F.when(F.col("dedup_count") > 0, F.col("raw_count") / F.col("dedup_count")).alias(
            "duplication_rate"
        ),
    )


def count_histogram(counts: DataFrame) -> DataFrame:
    """Compounds per power-of-two bin of `count`."""
    low = F.floor(F.log2(F.col("count"))).cast("int")
    return (
        counts.filter(F.col("count") > 0)
        .groupBy("selection_id", "library_id", low.alias("log2_bin"))
        .agg(F.count(F.lit(1)).alias("compounds"), F.sum("count").alias("count"))
    )


def report_tables(stats: DataFrame, counts: DataFrame, n_cycles: int | None = 3) -> dict[str, DataFrame]:
    """The tables behind a decode report."""
    return {
        "outcomes": outcome_columns(stats, n_cycles),
        "count_histogram": count_histogram(counts),
        "totals": count_summary(counts),
    }
