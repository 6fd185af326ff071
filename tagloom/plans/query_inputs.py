"""Files the query set reads: FASTQ lanes, vendor tables, run logs, accounting text.

All are derived from the given tables and written by Spark to the shared work folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import derived as d
from tagloom.session import materialize, new_path
from tagloom.sources.named_files import write_named_lines
from tagloom.sources.sinks import write_fastq


def staged_reads(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The derived reads as a stored table, as a run would find its reads; with the named columns, or all."""
    return materialize(d.derived_reads(spark, sf_dir).select(*(columns or ["*"])), "reads")


def derived_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compound counts straight from the columns the reads were made from."""
    truth = d.truth_reads(d.table(spark, sf_dir, "lineitem"))
    return truth.groupBy(
        "selection_id",
        F.concat(F.lit("L0"), "lib").alias("library_id"),
        F.concat_ws(",", "b1", "b2", "b3").alias("bb_ids"),
    ).agg(
        F.countDistinct("umi").alias("count"),
        F.count(F.lit(1)).alias("raw_count"),
        F.countDistinct("umi").alias("dedup_count"),
    )


# Reads in a file of a lane, about; a lane has four files at least. A gzip file is one task for those who read it.
READS_PER_FILE = 250_000
# Lanes of mates with more reads than this come compressed, as from a sequencer: two plain mates take 310 bytes a pair on shared disk.
PLAIN_READS = 4_000_000


def write_lanes(lines: DataFrame, reads: Callable[[DataFrame], DataFrame], label: str, plain: int | None = None) -> list[str]:
    """Three lanes in key order, the second gzip-compressed, and with `plain` any lane of more reads; returns the lane folders.

    Rows of `lines` are put in order first, and `reads` makes reads of them afterwards: keys are shuffled, not sequences.
    """
    spark = lines.sparkSession
    base = new_path(spark, label)
    own = F.col("l_orderkey") % 3
    counted = {r["lane"]: r["n"] for r in lines.groupBy(own.alias("lane")).agg(F.count(F.lit(1)).alias("n")).collect()}
    paths = []
    for lane in range(3):
        path = f"{base}/lane{lane}"
        files = max(4, -(-counted.get(lane, 0) // READS_PER_FILE))
        ordered = lines.filter(own == lane).repartitionByRange(files, *d.READ_KEY).sortWithinPartitions(*d.READ_KEY)
        large = plain is not None and counted.get(lane, 0) > plain
        write_fastq(reads(ordered), path, "gzip" if lane == 1 or large else None)
        paths.append(path)
    return paths


def vendor_folder(spark: SparkSession, sf_dir: str) -> str:
    """One vendor table per supplier, some with a seeded fault (supplier key mod 10)."""
    rows = (
        d.table(spark, sf_dir, "lineitem")
        .select(
            "l_suppkey",
            (F.col("l_linenumber") % 3 + 1).alias("cycle"),
            (F.col("l_partkey") % 50 + 1).alias("id"),
        )
        .distinct()
    )
    fault = F.col("l_suppkey") % 10
    kept = rows.filter(
        ~((fault == 3) & (F.col("cycle") == 1))
        & ~((fault == 4) & (F.col("cycle") == 2))
        & ~((fault == 6) & (F.col("cycle") == 3))
    )
    late = (fault == 5) & (F.col("cycle") == 1) & (F.col("id") > 25)
    place = F.col("cycle") * 1000 + F.col("id") + F.when(late, 10000).otherwise(0)
    r_coordinate = F.when((fault == 7) & (F.col("cycle") == 2), F.col("id") + 1).otherwise(F.col("id"))
    hits = F.when((fault == 8) & (F.col("cycle") == 1), "").otherwise(F.col("id").cast("string"))
    no_tag = (F.col("id") + F.col("l_suppkey")) % 17 == 0
    cell = F.when(no_tag, "").otherwise(d.dna(F.col("id") * 41 + F.col("cycle") * 7, 11))
    file = F.concat(F.lit("vendor_batch_L"), "l_suppkey", F.lit(".tsv"))
    lines = kept.select(
        file.alias("file"),
        place.cast("bigint").alias("place"),
        F.concat_ws("\t", r_coordinate.cast("string"), hits, "cycle", F.lit("[H]"), cell, F.lit("000"),
                    F.lit("[H]"), F.lit(""), "id").alias("text"),
    )
    heads = kept.select("l_suppkey").distinct().select(
        file.alias("file"),
        F.lit(-1).cast("bigint").alias("place"),
        F.concat_ws("\t", F.lit("R_coordinate"), F.lit("hits_index"), F.lit("0"), F.lit("lib_id"),
                    d.dna(F.col("l_suppkey") * 5 + 3, 12), F.lit("L00"), F.lit("structure"),
                    F.lit("deletion"), F.lit("similarity_coordinate")).alias("text"),
    )
    folder = new_path(spark, "vendor")
    write_named_lines(heads.unionByName(lines), folder, "file", "text", ["place"])
    return folder


def job_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of one job per event, with seeded gaps and repeats (event id mod 20)."""
    events = d.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    k = F.col("event_id") % 20
    process = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("DECODE:DecodeChunk ("), "event_id", F.lit(")")))
        .when(F.col("event_type") == "click", "PREPROCESS:CONCAT (1)")
        .when(F.col("event_type") == "error", F.concat(F.lit("CountChunk ("), "event_id", F.lit(")")))
        .when(F.col("event_type") == "purchase", "MergeStats")
        .otherwise("DECODE:Report (merged)")
    )
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    start = F.timestamp_diff("MILLISECOND", epoch, "ts")
    end = start + F.floor(F.col("value") * 1000).cast("bigint")
    iso = lambda ms: F.concat(
        F.date_format(F.timestamp_add("MILLISECOND", ms, epoch), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z")
    )

    def submitted(name):
        return F.concat(
            F.lit("Apr-07 15:43:37.000 [Task submitter] INFO  executor - [SLURM] submitted process "),
            name, F.lit(" > jobId: "), "event_id", F.lit("; workDir: /w"),
        )

    def completed(status, code, started, exited):
        return F.concat(
            F.lit("Apr-07 15:45:40.000 [Task monitor] DEBUG executor - Task completed > TaskHandler[jobId: "),
            "event_id", F.lit("; id: 1; status: "), status, F.lit("; exit: "), code,
            F.lit("; error: -; workDir: /w started: "), started, F.lit("; exited: "), exited,
            F.lit("; ] [queue]"),
        )

    started = F.when(k == 4, "-").otherwise(start.cast("string"))
    exited = (
        F.when(k == 5, "-").when(k == 6, iso(start - 300000)).otherwise(iso(end))
    )
    status = F.when(k == 8, "FAILED").otherwise("COMPLETED")
    code = F.when(k == 8, "1").otherwise("0")
    first = completed(F.lit("FAILED"), F.lit("9"), F.lit("1000"), iso(end))
    late = completed(F.lit("FAILED"), F.lit("2"), F.lit("-"), iso(end + 60000))
    texts = [
        F.lit("some other line > jobId"),
        F.when(k != 19, submitted(process)),
        F.when(k == 7, first),
        F.when(k == 7, submitted(F.lit("RETRY:Again (2)"))),
        F.when(k != 3, completed(status, code, started, exited)),
        F.when(k == 9, late),
    ]
    lines = F.array(*[F.struct(F.lit(n).alias("n"), t.alias("t")) for n, t in enumerate(texts)])
    run = F.concat(F.lit("run_"), F.floor(F.col("user_id") / 10).cast("bigint"), F.lit(".log"))
    return (
        events.select(run.alias("file"), "event_id", F.explode(lines).alias("l"))
        .select("file", "event_id", F.col("l.n").alias("n"), F.col("l.t").alias("text"))
        .filter(F.col("text").isNotNull())
    )


def log_folder(spark: SparkSession, sf_dir: str) -> str:
    folder = new_path(spark, "logs")
    write_named_lines(job_log_lines(spark, sf_dir), folder, "file", "text", ["event_id", "n"])
    return folder


def usage_folder(spark: SparkSession, sf_dir: str) -> str:
    """An accounting block for every event's job, units mixed."""
    events = d.table(spark, sf_dir, "events")
    secs = F.floor(F.col("value") * 10).cast("bigint")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    hours = F.floor(secs / 3600).cast("bigint")
    wall = F.concat_ws(":", two(hours), two(F.floor(secs / 60).cast("bigint") % 60), two(secs % 60))
    wall = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("1-"), wall)).otherwise(wall)
    unit = F.element_at(F.array(*[F.lit(u) for u in ("GB", "MB", "KB", "TB")]), (F.col("event_id") % 4 + 1).cast("int"))
    block = F.concat(
        F.lit("Job ID: "), "event_id", F.lit("\nCluster: c\nState: COMPLETED (exit code 0)\nCores per node: 2\n"),
        F.lit("CPU Utilized: 00:00:01\nCPU Efficiency: "), F.col("event_id") % 100,
        F.lit(".25% of 00:02:03 core-walltime\nJob Wall-clock time: "), wall,
        F.lit("\nMemory Utilized: "), F.col("event_id") % 1000 + 1, F.lit(".50 "), unit,
        F.lit("\nMemory Efficiency: "), F.col("event_id") % 90, F.lit(".5% of 5.00 GB"),
    )
    folder = new_path(spark, "usage")
    events.select(block.alias("value")).write.text(folder)
    return folder
