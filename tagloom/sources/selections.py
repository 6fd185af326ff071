"""Selection metadata: one row per selection experiment."""

from __future__ import annotations

from dataclasses import asdict
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import schemas
from tagloom.operators.decode import DecodeSettings

# Defaults of a selection that leaves a field out.
DEFAULTS = {
    "selection_id": "selection",
    "target_id": "target",
    "selection_condition": "-",
    "additional_info": "",
}


def _as_list(value) -> list[str]:
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def _as_date(value):
    if not value:
        return None
    return value if isinstance(value, date) else date.fromisoformat(str(value))


def selections_df(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Selections from parameter records; scalars stand for one-element lists."""
    out = []
    for row in rows:
        settings = DecodeSettings.of(row, **(row.get("decode_settings") or {}))
        text = {k: v if row.get(k) is None else str(row[k]) for k, v in DEFAULTS.items()}
        out.append(
            (
                text["selection_id"],
                text["target_id"],
                text["selection_condition"],
                _as_date(row.get("date_ran")),
                text["additional_info"],
                _as_list(row.get("sequence_files") or row.get("read_1")),
                _as_list(row.get("libraries")),
                tuple(asdict(settings).values()),
                row.get("prefix") or "",
            )
        )
    return spark.createDataFrame(out, schemas.SELECTIONS)


def selection_files(selections: DataFrame) -> DataFrame:
    """One row per sequence file; blank names dropped, a missing id becomes 'unknown'."""
    path = F.trim("file")
    return (
        selections.select(
            F.coalesce("selection_id", F.lit("unknown")).alias("selection_id"),
            F.posexplode("sequence_files").alias("lane", "file"),
        )
        .filter(F.length(path) > 0)
        .select("selection_id", "lane", path.alias("path"))
    )


def _must(ok: Column, value: Column, what: str) -> Column:
    bad = F.concat(F.lit(f"{what}, not "), F.coalesce(value.cast("string"), F.lit("null")))
    return F.coalesce(ok, F.lit(False)) | F.raise_error(bad).cast("boolean")


def validate_settings(selections: DataFrame) -> DataFrame:
    """Fail the job on a decode setting outside its allowed values.

    The checks are a filter: the planner drops columns that nothing reads, but no filter.
    """
    s = F.col("decode_settings")
    known = selections.schema["decode_settings"].dataType.names
    for name, values in DecodeSettings.allowed.items():
        if name not in known and name.endswith("_indels"):  # younger than the others: tables may lack it
            continue
        selections = selections.filter(_must(s[name].isin(*values), s[name], f"{name} must be one of {', '.join(values)}"))
    for name, least in (("library_error_tolerance", 0), ("min_library_overlap", 1)):
        selections = selections.filter(_must(s[name] >= least, s[name], f"{name} must be at least {least}"))
    return selections
