"""Vendor library tables: checks and conversion to library definitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.ids import bb_set_name
from tagloom.operators.layout import build_library_sections, library_sets

# Verdicts in the order the checks are made.
MALFORMED = "malformed"
BAD_FIRST_CYCLE = "first_cycle"
BAD_CYCLE_STEP = "cycle_step"
BAD_MAX_CYCLE = "max_cycle"
BAD_INDEX = "index_mismatch"
VALID = "ok"
FILE = ["file", "library_id"]


def cycle_steps(vendor_rows: DataFrame) -> DataFrame:
    """Add `step`, the change of cycle from the row before; null at the first row and beside nulls."""
    by_line = Window.partitionBy("file").orderBy("line_no")
    return vendor_rows.withColumn("step", F.col("cycle") - F.lag("cycle").over(by_line))


def first_cycle(vendor_rows: DataFrame) -> DataFrame:
    return vendor_rows.groupBy(*FILE).agg(F.min_by("cycle", "line_no").alias("first_cycle"))


def max_index_per_cycle(vendor_rows: DataFrame) -> DataFrame:
    """Highest index per cycle; rows without a cycle belong to none."""
    return (
        vendor_rows.filter(F.col("cycle").isNotNull())
        .groupBy(*FILE, F.col("cycle").cast("int").alias("cycle"))
        .agg(F.max(F.col("hits_index").try_cast("double")).alias("max_index"))
    )


def _index_equal():
    a, b = F.col("r_coordinate"), F.col("hits_index")
    x, y = a.try_cast("double"), b.try_cast("double")
    return F.coalesce(F.when(x.isNotNull() & y.isNotNull(), x == y).otherwise(a == b), F.lit(False))


def check_index_equal(vendor_rows: DataFrame) -> DataFrame:
    """Whether both index columns agree on every row; a missing value on either side disagrees."""
    return vendor_rows.groupBy(*FILE).agg(F.bool_and(_index_equal()).alias("index_equal"))


def null_tag_rows(vendor_rows: DataFrame) -> DataFrame:
    """Rows without a tag: reported, not rejected."""
    return vendor_rows.filter(F.col("tag").isNull()).select(*FILE, "line_no", "hits_index", "cycle")


def null_tag_counts(vendor_rows: DataFrame) -> DataFrame:
    return vendor_rows.groupBy(*FILE).agg(F.count_if(F.col("tag").isNull()).alias("null_tags"))


def validate_libraries(vendor_rows: DataFrame, expected_cycles: int = 3) -> DataFrame:
    """One verdict per file, the first check that fails."""
    facts = (
        cycle_steps(vendor_rows)
        .groupBy(*FILE)
        .agg(
            F.first("library_tag").alias("library_tag"),
            F.bool_and("well_formed").alias("well_formed"),
            F.min_by("cycle", "line_no").alias("first"),
            F.coalesce(F.bool_and(F.col("step").isin(0.0, 1.0)), F.lit(True)).alias("steps"),
            F.max("cycle").alias("last"),
            F.bool_and(_index_equal()).alias("index_equal"),
            F.count_if(F.col("tag").isNull()).alias("null_tags"),
        )
    )
    verdict = (
        F.when(~F.col("well_formed"), MALFORMED)
        .when(~F.col("first").eqNullSafe(F.lit(1.0)), BAD_FIRST_CYCLE)
        .when(~F.col("steps"), BAD_CYCLE_STEP)
        .when(~F.col("last").eqNullSafe(F.lit(float(expected_cycles))), BAD_MAX_CYCLE)
        .when(~F.col("index_equal"), BAD_INDEX)
        .otherwise(VALID)
    )
    return facts.select(*FILE, "library_tag", verdict.alias("verdict"), "null_tags")


def conversion_totals(verdicts: DataFrame) -> DataFrame:
    ok = F.col("verdict") == VALID
    return verdicts.agg(F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"))


def to_building_blocks(vendor_rows: DataFrame) -> DataFrame:
    """Building blocks in file order; a row without a cycle belongs to no set."""
    cycle = F.col("cycle").cast("int")
    return vendor_rows.filter(F.col("cycle").isNotNull()).select(
        "library_id",
        cycle.alias("cycle"),
        bb_set_name("library_id", cycle - 1).alias("bb_set_name"),
        F.col("hits_index").try_cast("double").cast("int").alias("id"),
        # As the file has it: an index that is no number is kept as text.
        F.coalesce(F.col("hits_index").try_cast("double").cast("int").cast("string"), "hits_index").alias("id_text"),
        "tag",
        "line_no",
    )


def split_by_cycle(vendor_rows: DataFrame) -> DataFrame:
    """Building blocks with the set each belongs to; the split itself is the partitioned write."""
    return to_building_blocks(vendor_rows)


def convert_libraries(vendor_rows: DataFrame, config: dict, expected_cycles: int = 3):
    """(verdicts, sections, sets, building blocks); failed files only have a verdict.

    Two valid files naming one library: the later file name wins, as when written one after another.
    """
    verdicts = validate_libraries(vendor_rows, expected_cycles)
    good = verdicts.filter(F.col("verdict") == VALID)
    good = good.groupBy("library_id").agg(
        F.max("file").alias("file"), F.max_by("library_tag", "file").alias("library_tag")
    )
    sections = build_library_sections(good, config)
    sets = library_sets(good, config)
    blocks = to_building_blocks(vendor_rows.join(good.select(*FILE), FILE, "left_semi"))
    return verdicts, sections, sets, blocks
