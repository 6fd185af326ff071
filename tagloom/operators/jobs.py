"""Run-log statistics: job records, status counts, summary per process."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.places import with_place
from tagloom.functions.text import (
    LOG_COMPLETED,
    LOG_EXITED,
    LOG_STARTED,
    LOG_SUBMITTED,
    base_process_name,
    dash_to_null,
    duration_min,
    epoch_ms_to_ts,
    extract,
    iso_to_ts,
    kv_pairs,
    last_value,
    mem_to_gb,
    pct_to_double,
    sem,
    wall_to_min,
)

DEFAULT_PROCESS = "__default__"


def classify_log_lines(lines: DataFrame) -> DataFrame:
    """Submitted and completed lines with their fields; a line matching both counts as submitted."""
    submitted = F.regexp_like("text", F.lit(LOG_SUBMITTED))
    completed = F.regexp_like("text", F.lit(LOG_COMPLETED))
    kind = F.when(submitted, "submitted").when(completed, "completed").otherwise("other")
    block = F.when(F.col("kind") == "completed", F.regexp_extract("text", LOG_COMPLETED, 1))
    fields = lines.withColumn("kind", kind).withColumn("block", block)
    fields = fields.withColumn("pairs", kv_pairs("block"))
    is_sub = F.col("kind") == "submitted"
    return fields.select(
        "run_id",
        "line",
        "kind",
        F.when(is_sub, F.regexp_extract("text", LOG_SUBMITTED, 2))
        .otherwise(F.coalesce(last_value("pairs", "jobId"), F.lit("")))
        .alias("job_id"),
        F.when(is_sub, F.trim(F.regexp_extract("text", LOG_SUBMITTED, 1))).alias("process"),
        F.when(~is_sub, F.coalesce(last_value("pairs", "status"), F.lit(""))).alias("status"),
        F.when(~is_sub, F.coalesce(last_value("pairs", "exit"), F.lit(""))).alias("exit_code"),
        dash_to_null(extract("block", LOG_STARTED)).alias("started"),
        dash_to_null(extract("block", LOG_EXITED)).alias("exited"),
    ).filter(F.col("kind") != "other")


def match_completions(classified: DataFrame) -> DataFrame:
    """Latest state per job, see latest_job_state: the match needs no join."""
    return latest_job_state(classified)


def latest_job_state(classified: DataFrame) -> DataFrame:
    """One row per submitted job: the last submission resets it, later completions fill it.

    Of the completions after the last submission the last gives status and exit code, and the last
    that has a value gives started and exited. All of it is maxima by line order, so one grouping
    with map-side combine does what would else be an ordered join.
    """
    sub = F.col("kind") == "submitted"

    def last(value, where):
        return F.max_by(value, F.when(where, F.col("line")))

    def last_line(where):
        return F.max(F.when(where, F.col("line")))

    state = classified.groupBy("run_id", "job_id").agg(
        last_line(sub).alias("submitted_at"),
        F.min(F.when(sub, F.col("line"))).alias("first_line"),
        last("process", sub).alias("process"),
        last_line(~sub).alias("completed_at"),
        last("status", ~sub).alias("status"),
        last("exit_code", ~sub).alias("exit_code"),
        last_line(~sub & F.col("started").isNotNull()).alias("started_at"),
        last("started", ~sub & F.col("started").isNotNull()).alias("started"),
        last_line(~sub & F.col("exited").isNotNull()).alias("exited_at"),
        last("exited", ~sub & F.col("exited").isNotNull()).alias("exited"),
    )
    after = lambda at, value: F.when(F.col(at) > F.col("submitted_at"), F.col(value))
    return state.filter(F.col("submitted_at").isNotNull()).select(
        "run_id",
        "job_id",
        "first_line",
        "process",
        after("completed_at", "status").alias("status"),
        after("completed_at", "exit_code").alias("exit_code"),
        after("started_at", "started").alias("started"),
        after("exited_at", "exited").alias("exited"),
    )


def clean_job_fields(states: DataFrame) -> DataFrame:
    """Typed times and the duration; a negative duration is missing."""
    typed = states.withColumns(
        {"started": epoch_ms_to_ts("started"), "exited": iso_to_ts("exited")}
    )
    return typed.withColumn("duration_min", duration_min("started", "exited"))


def job_records(lines: DataFrame) -> DataFrame:
    """Log lines to job records."""
    return clean_job_fields(latest_job_state(classify_log_lines(lines)))


def bad_timestamps(states: DataFrame) -> DataFrame:
    """Jobs whose exit time is no timestamp, per run."""
    bad = F.col("exited").isNotNull() & iso_to_ts("exited").isNull()
    return states.groupBy("run_id").agg(F.count_if(bad).alias("bad_timestamps"))


def order_by_submission(jobs: DataFrame, place: str | None = None) -> DataFrame:
    """Jobs by first submission; a re-submitted job keeps its place. `place` names a column that numbers the jobs of a run."""
    if place:
        return with_place(jobs, "first_line", group=("run_id",), name=place)
    return jobs.orderBy("run_id", "first_line")


def order_by_process(summary: DataFrame, place: str | None = None) -> DataFrame:
    """Groups by process name; `place` names a column that numbers them."""
    return with_place(summary, "process", name=place) if place else summary.orderBy("process")


def first_by(df: DataFrame, *order) -> DataFrame:
    """The first row in an explicit order."""
    return df.orderBy(*order).limit(1)


def attach_usage(jobs: DataFrame, usage: DataFrame) -> DataFrame:
    """Add accounting fields, one record per job; jobs without a record keep nulls."""
    return jobs.join(usage, "job_id", "left")


def resolve_resources(groups: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested cpus, memory and time per process; each field falls back to the default row.

    A row of `requested` may name several processes separated by '|'.
    """
    fields = ("cpus", "memory", "time")
    names = requested.select(
        F.explode(F.transform(F.split("process", r"\|"), F.trim)).alias("name"), *fields
    )
    wanted = groups.select("process").distinct()
    candidates = wanted.select(
        "process", F.posexplode(F.array("process", F.lit(DEFAULT_PROCESS))).alias("order", "name")
    )
    return (
        candidates.join(names, "name")
        .groupBy("process")
        .agg(
            *[
                F.min_by(f, F.when(F.col(f).isNotNull(), F.col("order"))).alias(f"req_{f}")
                for f in fields
            ]
        )
    )


def attach_requested(summary: DataFrame, requested: DataFrame) -> DataFrame:
    """Add req_cpus, req_memory and req_time per process."""
    return summary.join(resolve_resources(summary, requested), "process", "left")


def job_status_counts(jobs: DataFrame) -> DataFrame:
    done, failed = F.col("status") == "COMPLETED", F.col("status") == "FAILED"
    counts = jobs.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(done).alias("completed"),
        F.count_if(failed).alias("failed"),
    )
    return counts.withColumn("other", F.col("total") - F.col("completed") - F.col("failed"))


def job_summary(
    jobs: DataFrame, usage: DataFrame | None = None, requested: DataFrame | None = None
) -> DataFrame:
    """Mean and standard error per process; `n` counts all jobs, measured or not."""
    if usage is not None:
        jobs = attach_usage(jobs, usage)
        measures = {
            "wall_min": wall_to_min("wall_clock"),
            "cpu_eff_pct": pct_to_double("cpu_eff"),
            "mem_used_gb": mem_to_gb("mem_used"),
            "mem_eff_pct": pct_to_double("mem_eff"),
        }
    else:
        measures = {"dur_min": F.col("duration_min")}
    values = jobs.select(
        base_process_name("process").alias("process"), *[v.alias(k) for k, v in measures.items()]
    )
    aggregates = [F.count(F.lit(1)).alias("n")]
    for name in measures:
        aggregates += [F.avg(name).alias(f"avg_{name}"), sem(name).alias(f"sem_{name}")]
    summary = values.groupBy("process").agg(*aggregates)
    return summary if requested is None else attach_requested(summary, requested)
