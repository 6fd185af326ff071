"""Scans of counts, collected compounds, library definitions, vendor tables, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import schemas
from tagloom.functions.ids import file_name, file_stem, library_id_from_path
from tagloom.functions.text import (
    USAGE_CPU_EFF,
    USAGE_CPUS,
    USAGE_MEM_EFF,
    USAGE_MEM_REQUESTED,
    USAGE_MEM_USED,
    USAGE_WALL,
    extract,
)
from tagloom.session import new_path

# Texts a tab-separated vendor cell is read as missing for.
MISSING_CELLS = [
    "", " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
VENDOR_TAG_COLUMN = 4


def stored_path() -> Column:
    """Path of the row's file with its real characters; the metadata column holds it as a URI."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_counts(spark: SparkSession, paths: str | list[str], selection_id: str | None = None) -> DataFrame:
    """Compound counts; columns a file does not hold come back as null.

    `selection_id` fills in for files that carry none.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.schema(schemas.COUNTS).parquet(*paths)
    if selection_id is not None:
        df = df.withColumn("selection_id", F.coalesce("selection_id", F.lit(selection_id)))
    return df.select(*schemas.COUNTS.names)


def read_collected(spark: SparkSession, path: str | list[str], selection_id: str | None = None) -> DataFrame:
    df = spark.read.schema(schemas.COLLECTED).json(path)
    if selection_id is None:
        return df
    return df.select(F.lit(selection_id).alias("selection_id"), *schemas.COLLECTED.names)


def read_decoded(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Decoded reads from their tab-separated text."""
    return spark.read.schema(schemas.DECODED).option("sep", "\t").csv(path, header=True)


def read_vendor_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Vendor library tables, one file per library; the header of column 5 is the library tag.

    Each file is a small table of building blocks with its own header, so it is read whole and cut
    into numbered lines. Other columns are found by name.
    """
    files = spark.read.text(path, wholetext=True).select(
        stored_path().alias("path"), F.split("value", "\r?\n").alias("lines")
    )
    heads = files.select(
        file_name("path").alias("file"),
        library_id_from_path("path").alias("library_id"),
        F.split(F.element_at("lines", 1), "\t").alias("head"),
        F.posexplode("lines").alias("line_no", "line"),
    ).filter((F.col("line_no") > 0) & (F.trim("line") != ""))

    def cell(at):
        text = F.try_element_at(F.split("line", "\t"), at)
        return F.when(~text.isin(MISSING_CELLS), text)

    def named(name):
        at = F.array_position("head", name).cast("int")
        return F.when(at > 0, cell(F.greatest(at, F.lit(1))))

    has = lambda name: F.array_contains("head", name)
    well_formed = (
        has("R_coordinate")
        & has("hits_index")
        & has("0")
        & (F.size("head") > VENDOR_TAG_COLUMN)
        & (F.size(F.split("line", "\t")) <= F.size("head"))
    )
    return heads.select(
        "file",
        "library_id",
        F.try_element_at("head", F.lit(VENDOR_TAG_COLUMN + 1)).alias("library_tag"),
        "line_no",
        named("R_coordinate").alias("r_coordinate"),
        named("hits_index").alias("hits_index"),
        named("0").try_cast("double").alias("cycle"),
        cell(F.lit(VENDOR_TAG_COLUMN + 1)).alias("tag"),
        (well_formed & (named("0").isNull() | named("0").try_cast("double").isNotNull())).alias("well_formed"),
    )



def read_libraries(spark: SparkSession, path: str) -> DataFrame:
    """Library definitions, one JSON file per library, as sections with offsets.

    A map loses the order of a JSON object, so the order follows the section names.
    """
    from tagloom.operators.layout import section_offsets

    body = "struct<barcode_schema:map<string,struct<tag:string,overhang:string,error_correction:string>>>"
    sections = (
        spark.read.text(path, wholetext=True)
        .select(
            file_stem(stored_path()).alias("library_id"),
            F.from_json("value", body).alias("b"),
        )
        .select("library_id", F.explode("b.barcode_schema").alias("section", "s"))
    )
    kind = F.regexp_extract("section", r"^([a-z]+)", 1)
    group = F.when(F.col("section") == "primer2", 4)
    for at, name in enumerate(["primer", "bb", "library", "umi"]):
        group = group.when(kind == name, at)
    number = F.coalesce(F.regexp_extract("section", r"(\d+)$", 1).try_cast("int"), F.lit(0))
    place = F.struct(group.alias("group"), number.alias("number"))
    listed = sections.select(
        "library_id",
        place.alias("place"),
        "section",
        kind.alias("kind"),
        F.col("s.tag").alias("tag"),
        F.col("s.overhang").alias("overhang"),
        F.col("s.error_correction").alias("error_correction"),
    )
    in_order = listed.groupBy("library_id").agg(
        F.array_sort(
            F.collect_list(F.struct("place", "section", "kind", "tag", "overhang", "error_correction"))
        ).alias("all")
    )
    ordered = in_order.select("library_id", F.posexplode("all").alias("ord", "s")).select(
        "library_id", "ord", "s.section", "s.kind", "s.tag", "s.overhang", "s.error_correction"
    )
    return section_offsets(ordered)


def read_library_sets(spark: SparkSession, path: str) -> DataFrame:
    """Building-block sets named in the library definitions."""
    body = "struct<bb_sets:array<struct<cycle:int,bb_set_name:string>>,dna_barcode_on:string>"
    return (
        spark.read.text(path, wholetext=True)
        .select(
            file_stem(stored_path()).alias("library_id"),
            F.from_json("value", body).alias("b"),
        )
        .select("library_id", F.explode("b.bb_sets").alias("s"), "b.dna_barcode_on")
        .select("library_id", "s.cycle", "s.bb_set_name", "dna_barcode_on")
    )


def read_building_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Building-block tables named <library>_BB<letter>.csv with columns id, tag."""
    stem = file_stem(stored_path())
    return (
        spark.read.schema("id int, tag string")
        .csv(path, header=True)
        .select(
            F.regexp_extract(stem, r"^(.*)_BB[A-Z]$", 1).alias("library_id"),
            (F.ascii(F.regexp_extract(stem, r"_BB([A-Z])$", 1)) - 64).alias("cycle"),
            stem.alias("bb_set_name"),
            "id",
            "tag",
        )
    )


def read_run_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Log lines with their order: (start of the file split, row within it), so files stay splittable.

    `run_id` is the whole path: logs of one name in two folders are two runs. Spark passes over names that start with
    a dot or an underscore, so such logs are first copied to the work folder under another name.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    plain = [p for p in paths if p.rstrip("/").rsplit("/", 1)[-1][:1] not in (".", "_")]
    parts = [(plain, None)] * bool(plain) + [([copied(spark, p)], p) for p in paths if p not in plain]
    out = None
    for files, run_id in parts:
        lines = spark.read.text(files).select(
            (stored_path() if run_id is None else F.lit(run_id)).alias("run_id"),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("line"),
            F.col("value").alias("text"),
        )
        out = lines if out is None else out.unionByName(lines)
    return out


def copied(spark: SparkSession, path: str) -> str:
    """A copy of one file in the work folder, made by the file systems themselves."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(new_path(spark, "log"))
    jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, conf)
    return target.toString()


def read_usage_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Captured accounting output, one block per job starting with its 'Job ID: ' line. Of a job's blocks the last counts."""
    block = F.concat(F.lit("\n"), F.regexp_replace("value", r"^\s*Job ID: ", ""))
    blocks = spark.read.option("lineSep", "\nJob ID: ").text(path).select(
        block.alias("block"), F.struct(stored_path(), F.monotonically_increasing_id()).alias("line")
    )
    fields = {
        "wall_clock": USAGE_WALL,
        "cpu_eff": USAGE_CPU_EFF,
        "mem_used": USAGE_MEM_USED,
        "mem_eff": USAGE_MEM_EFF,
        "mem_requested": USAGE_MEM_REQUESTED,
        "alloc_cpus": USAGE_CPUS,
    }
    found = blocks.select(
        extract("block", r"^\s*(\d+)").alias("job_id"),
        "line",
        F.struct(*[extract("block", pattern).alias(name) for name, pattern in fields.items()]).alias("fields"),
    )
    last = found.filter(F.col("job_id").isNotNull()).groupBy("job_id").agg(F.max_by("fields", "line").alias("fields"))
    return last.select("job_id", "fields.*")
