"""Vendor library tables to library definitions."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tagloom.operators.vendor import conversion_totals, convert_libraries
from tagloom.session import materialize
from tagloom.sources.sinks import write_library_defs
from tagloom.sources.tables import read_vendor_tsv


def load_config(path: str) -> dict:
    """Barcode configuration from JSON, or from YAML where PyYAML is installed."""
    with open(path) as f:
        text = f.read()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("YAML configuration needs PyYAML; use JSON instead") from missing
    return yaml.safe_load(text)


def convert_folder(spark: SparkSession, input_dir: str, output_dir: str, config: dict) -> tuple[DataFrame, DataFrame]:
    """Convert every valid file; returns (verdict per file, totals)."""
    rows = materialize(read_vendor_tsv(spark, input_dir), "vendor-rows")
    verdicts, sections, sets, blocks = convert_libraries(rows, config)
    write_library_defs(sections, sets, blocks, output_dir)
    return verdicts, conversion_totals(verdicts)
