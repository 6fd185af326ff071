"""Sequencing inputs derived from the given TPC-H-like tables, for queries, tests and the bench.

Every row of `lineitem` becomes one read with a known library, building blocks, UMI and seeded
error, computed per row: no numbering of the whole table, so deriving needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture.
PRIMER1 = "AACCGGTTAAC"
PRIMER2 = "GGTTCCAATTGG"
OVERHANGS = ["AA", "CC", "GG"]
BB_LENGTH = 12
UMI_LENGTH = 12
ERROR_CORRECTION = "levenshtein_dist:1,asymmetrical"
JUNK = "ACGTTGCA"
CONFIG = {
    "primer1_tag": PRIMER1,
    "primer1_overhang": "",
    "primer2_tag": PRIMER2,
    "bb_overhangs": OVERHANGS,
    "bb_length": BB_LENGTH,
    "umi_length": UMI_LENGTH,
    "error_correction": ERROR_CORRECTION,
}

READ_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread a table that comes in fewer partitions than there are cores; a large one stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dna(x: Column, n: int) -> Column:
    """Base-4 digits of x, lowest first, as letters."""
    return F.concat(
        *[
            F.substr(F.lit("ACGT"), (F.floor(x / F.lit(4**k)) % 4 + 1).cast("int"), F.lit(1))
            for k in range(n)
        ]
    )


def sub(s: Column, p: int, k: int) -> Column:
    """Change k bases from position p."""
    return F.concat(
        F.substring(s, 1, p - 1),
        F.translate(F.substring(s, p, k), "ACGT", "CGTA"),
        F.substr(s, F.lit(p + k)),
    )


def _texts(texts: list[str]) -> Column:
    """A constant array. Looking a text up takes little code; a chain of steps that writes its letters one by one passes
    8000 bytes of bytecode, which the JVM does not compile."""
    return F.split(F.lit(",".join(texts)), ",")


def _looked_up(known: Column, at: Column) -> Column:
    """Null where the place is null: `element_at` of a constant array is taken for never null."""
    return F.when(at.isNotNull(), F.element_at(known, F.coalesce(at.cast("int"), F.lit(1))))


def _letters(x: int, n: int) -> str:
    """What `dna` makes of one number, negative ones included."""
    return "".join(("ACGT" if x >= 0 else "AGTA")[x // 4**k % 4] for k in range(n))


def tag(x: Column) -> Column:
    """Four letters of x three times over; they depend on its last four digits in base 4 and its sign."""
    known = _texts([_letters(k if k < 256 else k - 512, 4) * 3 for k in range(512)])
    return _looked_up(known, F.pmod(x, F.lit(256)) + F.when(x < 0, 257).otherwise(1))


def umi(u: Column) -> Column:
    """UMI of a number between -39 and 39."""
    known = _texts([_letters(k * 5 + 3, 6) * 2 for k in range(-39, 40)])
    return _looked_up(known, u + 40)


def _div(name: str, by: int) -> Column:
    return F.floor(F.col(name) / F.lit(by)).cast("bigint")


def error_code() -> Column:
    mix = (
        _div("l_orderkey", 40)
        + 3 * _div("l_partkey", 8)
        + 7 * _div("l_suppkey", 12)
        + 11 * F.col("l_linenumber")
    )
    return (mix % 20).cast("int")


def truth_reads(lineitem: DataFrame, read_id: Column | None = None, error: Column | None = None) -> DataFrame:
    """Reads with the columns they were made from."""
    key = F.concat(F.lit("r"), F.concat_ws(".", *READ_KEY)) if read_id is None else read_id
    base = lineitem.select(
        *READ_KEY,
        key.alias("read_id"),
        F.when(F.col("l_returnflag") == "R", "ctrl").otherwise("tgt").alias("selection_id"),
        (F.col("l_orderkey") % 2).cast("int").alias("rc"),
        (F.col("l_suppkey") % 3).cast("int").alias("lib"),
        (F.col("l_partkey") % 8).cast("int").alias("b1"),
        (F.col("l_suppkey") % 4).cast("int").alias("b2"),
        F.col("l_linenumber").cast("int").alias("b3"),
        (F.col("l_orderkey") % 40).cast("int").alias("u"),
        (error_code() if error is None else error.cast("int")).alias("e"),
    )
    e = F.col("e")
    tags = base.select(
        "*",
        tag(F.col("b1") + 16).alias("t1"),
        tag(F.col("b2") + 64).alias("t2"),
        tag(F.col("b3") + 128).alias("t3"),
        tag(F.col("lib") * 41 + 27).alias("tl"),
        umi(F.col("u")).alias("umi0"),
    )
    mutated = tags.withColumns(
        {
            "t2": F.when(e == 3, sub(F.col("t2"), 5, 1)).otherwise(F.col("t2")),
            "tl": F.when(e == 5, sub(F.col("tl"), 3, 2))
            .when(e == 17, sub(F.col("tl"), 1, 3))
            .otherwise(F.col("tl")),
            "umi": F.when(e == 9, sub(F.col("umi0"), 12, 1)).otherwise(F.col("umi0")),
            "t3": F.when(e == 13, sub(F.col("t3"), 1, 2)).otherwise(F.col("t3")),
        }
    )
    full = F.concat(
        F.when(e == 7, "T").otherwise(""),
        F.lit(PRIMER1),
        "t1",
        F.lit(OVERHANGS[0]),
        "t2",
        F.lit(OVERHANGS[1]),
        "t3",
        F.lit(OVERHANGS[2]),
        "tl",
        "umi",
        F.lit(PRIMER2),
    )
    whole = mutated.withColumn("full_fwd", full)
    fwd = (
        F.when(e == 11, JUNK * 8)
        .when(e == 15, F.substring("full_fwd", 1, 71))
        .otherwise(F.col("full_fwd"))
    )
    return whole.withColumn("fwd", fwd).select(
        *READ_KEY,
        "selection_id",
        "read_id",
        "rc",
        "lib",
        "b1",
        "b2",
        "b3",
        "umi",
        "e",
        "fwd",
        F.when(F.col("rc") == 1, F.translate(F.reverse("fwd"), "ACGT", "TGCA"))
        .otherwise(F.col("fwd"))
        .alias("seq"),
    )


def read_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*READ_KEY, "l_returnflag")


def reads_of(lines: DataFrame) -> DataFrame:
    return with_quality(truth_reads(lines)).select(
        *READ_KEY, "selection_id", "read_id", "seq", "qual"
    )


def derived_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads_of(spread(read_lines(spark, sf_dir)))


def with_quality(reads: DataFrame) -> DataFrame:
    return reads.withColumn("qual", F.repeat(F.lit("I"), F.length("seq")))


def noisy_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads with seeded low qualities, unread bases and short reads, for quality control."""
    e, n = F.col("e"), F.length("seq")
    return truth_reads(spread(table(spark, sf_dir, "lineitem"))).select(
        "selection_id",
        "read_id",
        F.when(e == 4, F.translate("seq", "A", "N"))
        .when(e == 2, F.substring("seq", 1, 14))
        .otherwise(F.col("seq"))
        .alias("seq"),
        F.when(e == 1, F.concat(F.repeat(F.lit("#"), F.lit(40)), F.repeat(F.lit("I"), n - 40)))
        .when(e == 6, F.concat(F.repeat(F.lit("#"), F.lit(30)), F.repeat(F.lit("5"), n - 30)))
        .when(e == 2, F.repeat(F.lit("I"), F.lit(14)))
        .otherwise(F.repeat(F.lit("I"), n))
        .alias("qual"),
    )


def derived_pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return pairs_of(spread(read_lines(spark, sf_dir)))


def pairs_of(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """64-base read pairs of each insert, some with one bad low-quality base in the overlap."""
    base = truth_reads(lines)
    e = F.col("e")
    end = F.translate(F.reverse(F.expr("right(fwd, 64)")), "ACGT", "TGCA")
    one, two = F.substring("fwd", 1, 64), end
    good, bad = F.lit("I" * 64), F.lit("I" * 59 + "#" + "I" * 4)
    common = [*READ_KEY, "selection_id", "read_id"]
    r1 = base.select(
        *common,
        F.when(e == 8, sub(one, 60, 1)).otherwise(one).alias("seq"),
        F.when(e == 8, bad).otherwise(good).alias("qual"),
    )
    r2 = base.select(
        *common,
        F.when(e == 6, sub(two, 60, 1)).otherwise(two).alias("seq"),
        F.when(e == 6, bad).otherwise(good).alias("qual"),
    )
    return r1, r2


def derived_library_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(library_id, library_tag) of the libraries that occur in the reads."""
    lib = (F.col("l_suppkey") % 3).cast("int")
    return (
        table(spark, sf_dir, "lineitem")
        .select(lib.alias("lib"))
        .distinct()
        .select(
            F.concat(F.lit("L0"), F.col("lib")).alias("library_id"),
            tag(F.col("lib") * 41 + 27).alias("library_tag"),
        )
    )


def derived_building_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Building blocks that occur in the reads, per library and cycle."""
    line = table(spark, sf_dir, "lineitem")
    lib = F.concat(F.lit("L0"), (F.col("l_suppkey") % 3))
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("cycle"),
                value.cast("int").alias("id"),
                F.lit(base).alias("base"),
            )
            for c, (value, base) in enumerate(
                [
                    (F.col("l_partkey") % 8, 16),
                    (F.col("l_suppkey") % 4, 64),
                    (F.col("l_linenumber"), 128),
                ],
                start=1,
            )
        ]
    )
    found = line.select(lib.alias("library_id"), F.explode(cells).alias("s")).distinct()
    return found.select(
        "library_id",
        F.col("s.cycle").alias("cycle"),
        F.concat("library_id", F.lit("_BB"), F.char(F.col("s.cycle") + 64)).alias("bb_set_name"),
        F.col("s.id").alias("id"),
        tag(F.col("s.id") + F.col("s.base")).alias("tag"),
    )
