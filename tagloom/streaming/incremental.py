"""Decoding of read files as they arrive, resumable after a failure.

The stream carries file names only. Each micro-batch decodes its new files and writes one partial
tally under its batch number, so a repeated batch replaces itself. Nothing is kept in memory
between batches; UMI clustering runs over the merged tally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.counts import count_compounds
from tagloom.operators.decode import DecodeSettings, DecodeTables, decode, prepare_tables
from tagloom.operators.stats import decode_stats
from tagloom.operators.umi import merge_tallies, tally_outcomes
from tagloom.session import materialize
from tagloom.sources.fastq import read_fastq

TALLY_SCHEMA = (
    "selection_id string, library_id string, outcome string, bb_ids string, umi string, c bigint"
)


def run_incremental(
    spark: SparkSession,
    in_dir: str,
    checkpoint: str,
    out_dir: str,
    library_sections: DataFrame,
    building_blocks: DataFrame,
    settings: DecodeSettings | None = None,
    selection_id: str | None = None,
    max_files_per_batch: int = 1000,
    tables: DecodeTables | None = None,
) -> None:
    """Decode all files not yet done under in_dir, then stop.

    Files lie in <in_dir>/<selection_id>/ unless `selection_id` names the one selection of the run.
    """
    settings = settings or DecodeSettings()
    tables = tables or prepare_tables(library_sections, building_blocks, settings)

    def work(batch: DataFrame, batch_id: int) -> None:
        # File names only, at most max_files_per_batch of them.
        paths = [r.path for r in batch.select("path").collect()]
        by_selection: dict[str, list[str]] = {}
        for path in sorted(paths):
            own = selection_id or path.rstrip("/").split("/")[-2]
            by_selection.setdefault(own, []).append(path)
        reads = None
        for name, files in by_selection.items():
            part = read_fastq(spark, files, 1, name)
            reads = part if reads is None else reads.unionByName(part)
        if reads is not None:
            tally = tally_outcomes(decode(reads, settings=settings, tables=tables))
            tally.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    stream = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{fastq,fq,fastq.gz,fq.gz,txt,txt.gz}")
        .option("maxFilesPerTrigger", max_files_per_batch)
        .load(in_dir)
        .select("path")
    )
    query = (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def merged_outcomes(spark: SparkSession, out_dir: str) -> DataFrame:
    """All partial tallies, summed by key."""
    parts = spark.read.schema(TALLY_SCHEMA).option("recursiveFileLookup", "true").parquet(out_dir)
    return merge_tallies(parts)


def incremental_counts(spark: SparkSession, out_dir: str) -> tuple[DataFrame, DataFrame]:
    """(counts, decode statistics) over everything decoded so far."""
    outcomes = materialize(merged_outcomes(spark, out_dir), "outcomes")
    tally = outcomes.filter(F.col("outcome") == "ok").drop("outcome")
    return count_compounds(tally), decode_stats(outcomes)
