"""Lookup tables of erroneous tags: turns approximate tag matching into equi-joins.

Each table is unique on its lookup key and takes one grouping to build. Two tags that explain an observed string equally well are
marked ambiguous here, once, so a read can never multiply in a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.dna import hamming, revcomp

# N is part of the alphabet: an unread base is a mismatch to every tag base.
BASES = ["A", "C", "G", "T", "N"]
AMBIGUOUS = "*"
# Lower is better: mismatches first, then the longer overlap.
RANK_BITS = 10
RANK_STEP = 1 << RANK_BITS


def _bases():
    return F.explode(F.array(*[F.lit(b) for b in BASES]))


def substitute_once(variants: DataFrame) -> DataFrame:
    """All strings at one substitution or none from `obs`."""
    return (
        variants.filter(F.length("obs") > 0)
        .withColumn("p", F.explode(F.sequence(F.lit(1), F.length("obs"))))
        .withColumn("b", _bases())
        .withColumn(
            "obs",
            F.concat(
                F.substr("obs", F.lit(1), F.col("p") - 1), "b", F.substr("obs", F.col("p") + 1)
            ),
        )
        .drop("p", "b")
    )


def shift_once(variants: DataFrame) -> DataFrame:
    """All strings of the same length after one deletion and one insertion in `obs`."""
    return (
        variants.filter(F.length("obs") > 0)
        .withColumn("p", F.explode(F.sequence(F.lit(1), F.length("obs"))))
        .withColumn("q", F.explode(F.sequence(F.lit(0), F.length("obs") - 1)))
        .withColumn("b", _bases())
        .withColumn(
            "cut",
            F.concat(F.substr("obs", F.lit(1), F.col("p") - 1), F.substr("obs", F.col("p") + 1)),
        )
        .withColumn(
            "obs",
            F.concat(F.substr("cut", F.lit(1), F.col("q")), "b", F.substr("cut", F.col("q") + 1)),
        )
        .drop("p", "q", "b", "cut")
    )


def substitution_variants(tags: DataFrame, distance: int) -> DataFrame:
    """`tag` plus every `obs` with at most `distance` mismatches."""
    out = tags.withColumn("obs", F.col("tag"))
    for _ in range(distance):
        out = substitute_once(out)
    return out


def edit_variants(tags: DataFrame, distance: int) -> DataFrame:
    """`tag` plus every equal-length `obs` at edit distance <= `distance`.

    An edit script between strings of equal length is s substitutions and m deletion/insertion
    pairs with s + 2m <= distance.
    """
    levels = [tags.withColumn("obs", F.col("tag"))]
    for d in range(1, distance + 1):
        level = substitute_once(levels[d - 1])
        if d >= 2:
            level = level.unionByName(shift_once(levels[d - 2]))
        levels.append(level)
    return levels[distance]


def on_strands(table: DataFrame, strands: list[str]) -> DataFrame:
    """One copy per strand to be read: windows of a reverse strand stay unreversed in the reads,
    so the few table rows are reverse-complemented instead of every read."""
    both = F.explode(F.array(*[F.lit(s) for s in strands]))
    return table.withColumn("strand", both).withColumn(
        "obs", F.when(F.col("strand") == "-", revcomp("obs")).otherwise(F.col("obs"))
    )


def library_variants(libraries: DataFrame, tolerance: int = 2, min_overlap: int = 8) -> DataFrame:
    """(class_id, obs) -> rank, library_id over (class_id, library_id, tag).

    Holds whole tags and their prefixes of at least `min_overlap` bases, for tags cut off by the
    read end. `library_id` is AMBIGUOUS when two libraries tie.
    """
    prefixes = (
        libraries.filter(F.col("tag").isNotNull() & (F.length("tag") > 0))
        .withColumn(
            "n",
            F.explode(
                F.sequence(F.least(F.lit(min_overlap), F.length("tag")), F.length("tag"))
            ),
        )
        .select("class_id", "library_id", F.substr("tag", F.lit(1), F.col("n")).alias("tag"))
    )
    ranked = substitution_variants(prefixes, tolerance).withColumn(
        "rank", hamming("tag", "obs") * RANK_STEP + (RANK_STEP - 1 - F.length("obs"))
    )
    best = ranked.groupBy("class_id", "obs").agg(
        F.min(F.struct("rank", "library_id")).alias("low"),
        F.max(F.struct((-F.col("rank")).alias("neg"), "library_id")).alias("high"),
    )
    unique = F.col("low.library_id") == F.col("high.library_id")
    return best.select(
        "class_id",
        "obs",
        F.col("low.rank").alias("rank"),
        F.when(unique, F.col("low.library_id")).otherwise(AMBIGUOUS).alias("library_id"),
    )


def building_block_variants(building_blocks: DataFrame, distance: int = 1) -> DataFrame:
    """(library_id, cycle, obs) -> id, ambiguous over (library_id, cycle, id, tag).

    A column `allowed` holds the distance of a row's own library and cycle; `distance` is the largest of them.
    """
    allowed = F.col("allowed") if "allowed" in building_blocks.columns else F.lit(distance)
    tags = building_blocks.filter(F.col("tag").isNotNull() & (F.length("tag") > 0)).select(
        "library_id", "cycle", "id", "tag", allowed.alias("allowed")
    )
    near = edit_variants(tags, distance).withColumn("distance", F.levenshtein("tag", "obs"))
    near = near.filter(F.col("distance") <= F.col("allowed"))
    best = near.groupBy("library_id", "cycle", "obs").agg(
        F.min(F.struct("distance", "id")).alias("low"),
        F.max(F.struct((-F.col("distance")).alias("neg"), "id")).alias("high"),
    )
    unique = F.col("low.id") == F.col("high.id")
    return best.select(
        "library_id",
        "cycle",
        "obs",
        F.when(unique, F.col("low.id")).alias("id"),
        (~unique).alias("ambiguous"),
    )
