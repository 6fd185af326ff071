"""From reads or counts to enrichment, for many selections in one job."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.counts import count_compounds, deduplicate, synthon_counts
from tagloom.operators.decode_groups import decode_groups, prepare_groups
from tagloom.operators.enrich import enrichment, observed_blocks
from tagloom.operators.preprocess import filter_reads, merge_pairs
from tagloom.operators.stats import decode_stats, decode_summary, merge_stats, report_tables
from tagloom.operators.umi import collect_umis, tally_outcomes
from tagloom.session import materialize
from tagloom.sources import sinks
from tagloom.sources.fastq import read_fastq, read_fastq_pairs

# Outcome of reads whose selection is not in the selections table.
UNLISTED = "unknown_selection"


@dataclass
class RunResult:
    enrichment: DataFrame
    counts: DataFrame
    synthons: DataFrame | None = None
    tally: DataFrame | None = None
    stats: DataFrame | None = None
    summary: DataFrame | None = None
    report: dict[str, DataFrame] = field(default_factory=dict)


def same_template(pairs: DataFrame) -> DataFrame:
    """Fail the job on a pair whose ids differ before the first blank or slash."""
    bare = lambda c: F.regexp_replace(c, r"[ /].*$", "")
    what = F.concat(F.lit("mates are not in the same order: "), "read_id", F.lit(" and "), "read_id_r2")
    return pairs.filter((bare("read_id") == bare("read_id_r2")) | F.raise_error(what).cast("boolean"))


def prepare_reads(
    spark: SparkSession,
    read_1,
    read_2=None,
    selection_id: str = "selection",
    quality: dict | None = None,
    spread: int | None = None,
    unpaired: str = "error",
    **fastq_options,
) -> DataFrame:
    """Single-end reads, or merged pairs of two lists of lanes.

    `quality` holds the rules of `filter_reads` (an empty dict: its defaults), None keeps all reads. `spread` deals pairs
    out to so many tasks after the scan: a gzip lane is one task, and merging and decoding would stay in it.
    """
    if not read_2:
        reads = read_fastq(spark, read_1, 1, selection_id, **fastq_options)
    else:
        pairs = same_template(read_fastq_pairs(spark, read_1, read_2, selection_id, unpaired=unpaired, **fastq_options))
        reads = merge_pairs(pairs.repartition(spread) if spread else pairs)
    return reads if quality is None else filter_reads(reads, **quality)


def decode_selections(
    reads: DataFrame, selections: DataFrame, library_sections: DataFrame, building_blocks: DataFrame
) -> DataFrame:
    """Decode every selection against its own libraries, or all if it names none, with its own settings, in one scan.

    Reads of selections that aren't listed come back with the outcome UNLISTED, so no read is lost.
    """
    return decode_groups(reads, prepare_groups(selections, library_sections, building_blocks), UNLISTED)


def run(
    selections: DataFrame | None = None,
    reads: DataFrame | None = None,
    counts: DataFrame | None = None,
    library_sections: DataFrame | None = None,
    building_blocks: DataFrame | None = None,
    z: float = 1.96,
) -> RunResult:
    """Exactly one of `reads` (decode, count, enrich) or `counts` (enrich only). Libraries may differ in cycles."""
    if (reads is None) == (counts is None):
        raise ValueError("give either reads or counts, not both and not neither")
    if building_blocks is None and counts is None:
        raise ValueError("building blocks are needed")
    if counts is not None:
        final = materialize(deduplicate(counts), "counts")
        # Without definitions a library is what its counts show of it.
        building_blocks = observed_blocks(final) if building_blocks is None else building_blocks
        return RunResult(enrichment(final, building_blocks, z), final, synthon_counts(final))

    decoded = decode_selections(reads, selections, library_sections, building_blocks)
    # One pass over the reads: tally and statistics both come from this table.
    outcomes = materialize(tally_outcomes(decoded), "outcomes")
    tally = outcomes.filter(F.col("outcome") == "ok").drop("outcome")
    stats = decode_stats(outcomes)
    final = materialize(deduplicate(count_compounds(tally)), "counts")
    return RunResult(
        enrichment(final, building_blocks, z),
        final,
        synthon_counts(final),
        tally,
        stats,
        decode_summary(final, stats, None),
        report_tables(stats, final, None),
    )


def write_run(result: RunResult, out_dir: str, selections: DataFrame | None = None, prefix: str = "") -> None:
    """All outputs of a run under `out_dir`."""
    sinks.write_counts(result.counts, f"{out_dir}/counts")
    sinks.write_table(result.counts, f"{out_dir}/deduplicated.parquet")
    sinks.write_table(result.enrichment, f"{out_dir}/enrichment.parquet")
    if result.synthons is not None:
        sinks.write_table(result.synthons, f"{out_dir}/synthons.parquet")
    if result.tally is not None:
        sinks.write_collected(collect_umis(result.tally), f"{out_dir}/collected")
    if result.stats is not None:
        texts = sinks.stats_json(result.stats)
        sinks.write_stats_json(texts, out_dir, "decode_stats", selections, prefix)
        sinks.write_table(merge_stats(result.stats), f"{out_dir}/decode_stats.parquet")
    if result.summary is not None:
        texts = sinks.rows_json(result.summary)
        sinks.write_stats_json(texts, out_dir, "decode_summary", selections, prefix)
    for name, df in result.report.items():
        sinks.write_table(df, f"{out_dir}/report/{name}.parquet")
