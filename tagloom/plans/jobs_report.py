"""Run logs and captured accounting text to job tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.operators.jobs import attach_usage, job_records, job_status_counts, job_summary
from tagloom.sources.sinks import write_job_tables
from tagloom.sources.tables import read_run_log, read_usage_text


def report_jobs(
    spark: SparkSession, log, usage=None, requested: DataFrame | None = None, output: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(jobs, summary, status counts); written as CSV when `output` names a file."""
    jobs = job_records(read_run_log(spark, log))
    used = None if usage is None else read_usage_text(spark, usage)
    summary = job_summary(jobs, used, requested)
    if output:
        write_job_tables(jobs if used is None else attach_usage(jobs, used), summary, output)
    return jobs, summary, job_status_counts(jobs)
