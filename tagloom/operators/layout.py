"""Barcode layout: the ordered sections of each library's reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.dna import n_mask

# Layouts are metadata (a few sections per library) and the only table read by the driver.
MAX_LIBRARIES = 100_000


def build_library_sections(library_tags: DataFrame, config: dict) -> DataFrame:
    """Ordered sections per library from (library_id, library_tag) and the barcode config.

    The number of building-block sections follows the configured overhangs.
    """
    no_text = F.lit(None).cast("string")

    def section(name, kind, tag, overhang=None, correction=None):
        return F.struct(
            F.lit(name).alias("section"),
            F.lit(kind).alias("kind"),
            tag.alias("tag"),
            (no_text if overhang is None else F.lit(overhang)).alias("overhang"),
            (no_text if correction is None else F.lit(correction)).alias("error_correction"),
        )

    sections = [section("primer1", "primer", F.lit(config["primer1_tag"]), config["primer1_overhang"])]
    for i, overhang in enumerate(config["bb_overhangs"], start=1):
        mask = n_mask(config["bb_length"])
        sections.append(section(f"bb{i}", "bb", mask, overhang, config["error_correction"]))
    sections.append(section("library", "library", F.col("library_tag")))
    sections.append(section("umi", "umi", n_mask(config["umi_length"])))
    sections.append(section("primer2", "primer", F.lit(config["primer2_tag"])))
    return section_offsets(
        library_tags.select("library_id", F.posexplode(F.array(*sections)).alias("ord", "s")).select(
            "library_id", "ord", "s.*"
        )
    )


def section_offsets(sections: DataFrame) -> DataFrame:
    """Add 0-based `start` and `len`: running sums over the sections of one library."""
    width = F.coalesce(F.length("tag"), F.lit(0)) + F.coalesce(F.length("overhang"), F.lit(0))
    before = (
        Window.partitionBy("library_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    )
    return sections.withColumns(
        {
            "start": F.coalesce(F.sum(width).over(before), F.lit(0)).cast("int"),
            "len": F.coalesce(F.length("tag"), F.lit(0)),
        }
    )


def library_sets(library_tags: DataFrame, config: dict) -> DataFrame:
    """Building-block sets of each library: (library_id, cycle, bb_set_name, dna_barcode_on)."""
    from tagloom.functions.ids import bb_set_name

    n = len(config["bb_overhangs"])
    return library_tags.select(
        "library_id", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("cycle")
    ).select(
        "library_id",
        "cycle",
        bb_set_name("library_id", F.col("cycle") - 1).alias("bb_set_name"),
        bb_set_name("library_id", F.lit(0)).alias("dna_barcode_on"),
    )


@dataclass(frozen=True)
class Layout:
    """Section positions shared by a class of libraries; bb and umi relative to the library tag."""

    library_start: int
    tag_length: int
    umi_offset: int
    umi_length: int
    bbs: tuple[tuple[int, int, int], ...]  # (cycle, offset, length)
    distance: int


def read_layouts(sections: DataFrame) -> dict[Layout, list[str]]:
    """Layout classes with the libraries that use them."""
    wanted = sections.filter(F.col("kind").isin("bb", "library", "umi")).select(
        "library_id",
        F.struct(
            "kind",
            "section",
            "start",
            "len",
            F.regexp_extract("error_correction", r":\s*(\d+)", 1).try_cast("int").alias("distance"),
        ).alias("s"),
    )
    rows = (
        wanted.groupBy("library_id")
        .agg(F.collect_list("s").alias("s"))
        .limit(MAX_LIBRARIES + 1)
        .collect()
    )
    if len(rows) > MAX_LIBRARIES:
        raise ValueError(f"more than {MAX_LIBRARIES} library definitions")
    out: dict[Layout, list[str]] = {}
    for row in rows:
        lib = next(s for s in row.s if s.kind == "library")
        umi = next(s for s in row.s if s.kind == "umi")
        bbs = sorted((int(s.section[2:]), s.start - lib.start, s.len) for s in row.s if s.kind == "bb")
        distances = {s.distance or 0 for s in row.s if s.kind == "bb"}
        layout = Layout(
            lib.start, lib.len, umi.start - lib.start, umi.len, tuple(bbs), max(distances, default=0)
        )
        out.setdefault(layout, []).append(row.library_id)
    return {k: sorted(out[k]) for k in sorted(out, key=lambda v: (v.library_start, v.tag_length, str(v)))}
