"""Barcode calling: orientation, library, building blocks, UMI, outcome.

A narrow stage from the scan on: every call is a left join against a lookup table of erroneous
tags (broadcast while its counted size allows), so reads are neither shuffled nor multiplied.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.dna import extract_section, revcomp, strand_section
from tagloom.operators.indel_search import search_indels
from tagloom.operators.layout import Layout, read_layouts
from tagloom.operators.search import search_library
from tagloom.operators.section_indels import call_open_sections
from tagloom.operators.variants import (
    AMBIGUOUS,
    RANK_BITS,
    building_block_variants,
    library_variants,
    on_strands,
)
from tagloom.session import (
    BROADCAST_ROWS,
    end_span,
    is_small,
    lookup,
    materialize,
    sized_broadcast,
)

SHIFTS = (0, -1, 1)
CYCLES_PER_SPAN = 2
YES_NO = ("YES", "NO")


@dataclass(frozen=True)
class DecodeSettings:
    library_error_tolerance: int = 2
    min_library_overlap: int = 8
    revcomp: str = "YES"
    demultiplexer_algorithm: str = "regex"
    demultiplexer_mode: str = "single"
    realign: str = "NO"
    wiggle: str = "YES"
    # Reads that the library call leaves open are searched once more, for tags with insertions and deletions.
    library_indels: str = "NO"
    # Sections that the lookups leave open are tried with windows of other lengths.
    section_indels: str = "NO"

    allowed = {
        "revcomp": (*YES_NO, "BOTH"),
        "demultiplexer_algorithm": ("regex", "cutadapt"),
        "demultiplexer_mode": ("single", "library"),
        "realign": YES_NO,
        "wiggle": YES_NO,
        "library_indels": YES_NO,
        "section_indels": YES_NO,
    }

    def __post_init__(self):
        for name, values in self.allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name}={getattr(self, name)!r}, expected one of {values}")
        if self.library_error_tolerance < 0 or self.min_library_overlap < 1:
            raise ValueError("library_error_tolerance >= 0 and min_library_overlap >= 1 expected")

    @classmethod
    def of(cls, values: dict | None = None, **more) -> DecodeSettings:
        given = {k: v for k, v in {**(values or {}), **more}.items() if v is not None}
        return replace(cls(), **{f.name: given[f.name] for f in fields(cls) if f.name in given})

    @property
    def shifts(self) -> tuple[int, ...]:
        return SHIFTS if self.wiggle == "YES" else (0,)


def restrict_libraries(table: DataFrame, library_ids) -> DataFrame:
    """Keep the rows of the named libraries; a list, or a DataFrame with `libraries` arrays."""
    if isinstance(library_ids, DataFrame):
        named = library_ids.select(F.explode("libraries").alias("library_id")).distinct()
        return table.join(sized_broadcast(named), "library_id", "left_semi")
    return table.filter(F.col("library_id").isin(list(library_ids)))


def _strands(settings: DecodeSettings) -> list[str]:
    return {"YES": ["-"], "NO": ["+"], "BOTH": ["+", "-"]}[settings.revcomp]


def best_candidate(candidates: list[tuple[Column, Column, Column]]) -> tuple[Column, Column, Column]:
    """Lowest-ranked of (rank, library, position) columns, given in order of preference.

    Two different libraries at the best rank make it ambiguous. Column expressions only: no sort,
    no shuffle.
    """
    ranks = [r for r, _, _ in candidates]
    best = F.least(*ranks) if len(ranks) > 1 else ranks[0]
    hits = [F.when(r == best, lib) for r, lib, _ in candidates]
    first = F.coalesce(*hits)
    tie = F.lit(False)
    for hit in hits[1:]:
        tie = tie | F.coalesce(hit != first, F.lit(False))
    pos = F.coalesce(*[F.when(r == best, p) for r, _, p in candidates])
    return best, F.when(tie, AMBIGUOUS).otherwise(first), pos


def call_library(
    reads: DataFrame,
    variants: DataFrame,
    layouts: list[Layout],
    settings: DecodeSettings,
    broadcast: bool = True,
) -> DataFrame:
    """Library call at the layout position, moved by the wiggle shifts.

    Adds strand, library_id (AMBIGUOUS on ties), lib_pos (on that strand) and lib_mismatches.
    """
    out = reads
    found: dict[str, list] = {s: [] for s in _strands(settings)}
    for class_id, layout in enumerate(layouts):
        out = end_span(out) if class_id else out
        for strand in found:
            table = variants.filter((F.col("class_id") == class_id) & (F.col("strand") == strand))
            for shift in sorted(settings.shifts):
                at = layout.library_start + shift
                if at < 0:
                    continue
                if strand == "+":
                    window = extract_section("seq", at, layout.tag_length)
                else:
                    window = strand_section(
                        "seq", f"length(seq) - {at}", "-1", "0", 0, layout.tag_length
                    )
                name = f"{strand}{class_id}_{shift}"
                out = lookup(
                    out,
                    table,
                    {"obs": window},
                    {"rank": f"__r{name}", "library_id": f"__l{name}"},
                    broadcast,
                    spread=F.col("read_id"),
                )
                found[strand].append((at, F.col(f"__r{name}"), F.col(f"__l{name}")))
    calls = {}
    for strand, candidates in found.items():
        leftmost_first = sorted(candidates, key=lambda c: c[0])
        rank, library, pos = best_candidate([(r, lib, F.lit(at)) for at, r, lib in leftmost_first])
        calls.update({f"__rank{strand}": rank, f"__lib{strand}": library, f"__pos{strand}": pos})
    out = out.select(*reads.columns, *[c.alias(n) for n, c in calls.items()])
    return _pick_strand(out, reads.columns, settings)


def _pick_strand(out: DataFrame, kept: list[str], settings: DecodeSettings) -> DataFrame:
    """Strand with fewer library mismatches; forward on a tie."""
    strands = _strands(settings)
    mismatches = {s: F.shiftright(F.col(f"__rank{s}"), RANK_BITS) for s in strands}
    if len(strands) == 1:
        reverse = F.lit(strands[0] == "-")
    else:
        far = F.lit(1 << 20)
        reverse = F.coalesce(mismatches["-"], far) < F.coalesce(mismatches["+"], far)

    def pick(of):
        if len(strands) == 1:
            return of(strands[0])
        return F.when(reverse, of("-")).otherwise(of("+"))

    return out.select(
        *kept,
        F.when(reverse, "-").otherwise("+").alias("strand"),
        pick(lambda s: F.col(f"__lib{s}")).alias("library_id"),
        pick(lambda s: F.col(f"__pos{s}")).alias("lib_pos"),
        pick(lambda s: mismatches[s]).alias("lib_mismatches"),
    )


def with_anchor(called: DataFrame) -> DataFrame:
    """Anchor of the called library tag in read coordinates and the key of its building blocks."""
    reverse = F.col("strand") == "-"
    return called.withColumns(
        {
            "__sign": F.when(reverse, -1).otherwise(1),
            "__base": F.when(reverse, F.length("seq") - F.col("lib_pos")).otherwise(F.col("lib_pos")),
            "__key": F.concat("strand", "library_id"),
        }
    )


def _section(rel, length) -> Column:
    return strand_section("seq", "__base", "__sign", f"(lib_pos + {rel})", rel, length)


def attach_layout(reads: DataFrame, layouts: dict[Layout, list[str]], broadcast: bool = True) -> DataFrame:
    """Section positions of the called library as columns __off<i>, __len<i>, __uoff, __ulen."""
    spark = reads.sparkSession
    cycles = sorted({c for layout in layouts for c, _, _ in layout.bbs})
    rows = []
    for layout, libraries in layouts.items():
        by_cycle = {c: (off, n) for c, off, n in layout.bbs}
        cells = [v for c in cycles for v in by_cycle.get(c, (None, None))]
        rows += [(lib, layout.umi_offset, layout.umi_length, *cells) for lib in libraries]
    names = ["__uoff", "__ulen"] + [f"__{k}{c}" for c in cycles for k in ("off", "len")]
    schema = "library_id string, " + ", ".join(f"{n} int" for n in names)
    table = spark.createDataFrame(rows, schema)
    return lookup(
        reads, table, {"library_id": F.col("library_id")}, {n: n for n in names}, broadcast,
        spread=F.col("read_id"),
    )


def _section_columns(layouts: dict[Layout, list[str]], settings: DecodeSettings):
    """Per cycle (offset, length), then the UMI's: numbers in single mode, column names otherwise."""
    if settings.demultiplexer_mode == "single":
        layout = next(iter(layouts))
        bbs = {c: (off, n) for c, off, n in layout.bbs}
        return bbs, (layout.umi_offset, layout.umi_length)
    cycles = sorted({c for layout in layouts for c, _, _ in layout.bbs})
    return {c: (f"__off{c}", f"__len{c}") for c in cycles}, ("__uoff", "__ulen")


def after_called_end(bbs: dict, umi_offset) -> tuple[dict, str]:
    """Sections behind the library tag follow the end it was found at: the tag may be longer or shorter than it should be."""
    moved = lambda offset: f"({offset} + IF({offset} > 0, coalesce(lib_surplus, 0), 0))"
    return {c: (moved(offset), n) for c, (offset, n) in bbs.items()}, moved(umi_offset)


def call_building_blocks(
    reads: DataFrame,
    variants: DataFrame,
    cycle: int,
    offset,
    length,
    settings: DecodeSettings,
    broadcast: bool = True,
    anchor: str = "0",
    only: str | None = None,
    wiggle: str | None = None,
) -> DataFrame:
    """Call one cycle's building block: first wiggle shift with a unique tag wins.

    Adds __bb<i> (id or null), __amb<i> and __sh<i> (the shift used). A later shift is looked up
    only for reads the earlier ones left open; the others carry a null key. `only` and `wiggle` are
    conditions for any look and for looks at a shift.
    """
    table = variants.filter(F.col("cycle") == cycle)
    out, tried = reads, []
    for n, shift in enumerate(settings.shifts):
        key = _section(f"{offset} + {anchor} + ({shift})", length)
        still_open = [only] * (only is not None) + [f"{earlier} IS NULL" for earlier in tried]
        still_open += [wiggle] * (wiggle is not None and shift != 0)
        if still_open:
            key = F.when(F.expr(" AND ".join(still_open)), key)
        out = lookup(
            out,
            table,
            {"key": F.col("__key"), "obs": key},
            {"id": f"__id{n}", "ambiguous": f"__a{n}"},
            broadcast,
            spread=F.col("read_id"),
        )
        tried.append(f"__id{n}")
    ambiguous = " OR ".join(f"coalesce(__a{n}, false)" for n in range(len(tried)))
    used = " ".join(f"WHEN {c} IS NOT NULL THEN {s}" for c, s in zip(tried, settings.shifts))
    return out.selectExpr(
        *[f"`{c}`" for c in reads.columns],
        f"coalesce({', '.join(tried)}) AS __bb{cycle}",
        f"{ambiguous} AS __amb{cycle}",
        f"CASE {used} END AS __sh{cycle}",
    )


def realign_sections(
    reads: DataFrame,
    variants: DataFrame,
    bbs: dict,
    settings: DecodeSettings,
    broadcast: bool = True,
    only: str = "true",
    wiggle: str | None = None,
) -> DataFrame:
    """Second try for uncalled sections, anchored on the neighbour nearer to the library tag.

    Indels between the library tag and a section add up; the neighbour's called shift already holds
    those on the way, so each section is looked for around that shift instead of around zero.
    """
    out, anchor = reads, F.lit(0)
    for cycle in sorted(bbs, reverse=True):
        out = end_span(out)
        offset, length = bbs[cycle]
        first = {k: f"__first_{k}" for k in (f"__bb{cycle}", f"__amb{cycle}", f"__sh{cycle}")}
        out = out.withColumn("__anchor", anchor).withColumnsRenamed(first)
        still_open = f"{first[f'__bb{cycle}']} IS NULL AND __anchor <> 0"
        still_open += f" AND {only}" * (only != "true")
        out = call_building_blocks(
            out, variants, cycle, offset, length, settings, broadcast, "__anchor", still_open, wiggle
        )
        bb, amb, sh = f"__bb{cycle}", f"__amb{cycle}", f"__sh{cycle}"
        out = out.withColumns(
            {
                bb: F.coalesce(F.col(first[bb]), F.col(bb)),
                amb: F.col(first[amb]) | F.col(amb),
                sh: F.coalesce(F.col(first[sh]), F.col("__anchor") + F.col(sh)),
            }
        ).drop("__anchor", *first.values())
        anchor = F.coalesce(F.col(sh), F.lit(0))
    return out


def classify_outcome(
    too_short: Column, library: Column, bbs: dict[int, tuple[Column, Column, Column]], umi_ok: Column
) -> Column:
    """First failing step; `bbs` maps cycle -> (has the section, id, ambiguous)."""
    outcome = (
        F.when(too_short & library.isNull(), "too_short")
        .when(library.isNull(), "no_library")
        .when(library == AMBIGUOUS, "ambiguous_library")
    )
    for cycle, (present, bb, ambiguous) in sorted(bbs.items()):
        failed = present & bb.isNull()
        outcome = outcome.when(failed & ambiguous, f"bb{cycle}_ambiguous").when(
            failed, f"bb{cycle}_unmatched"
        )
    return outcome.when(~F.coalesce(umi_ok, F.lit(False)), "umi_invalid").otherwise("ok")


def outcome_names(n_cycles: int) -> list[str]:
    per_bb = [f"bb{i}_{why}" for i in range(1, n_cycles + 1) for why in ("unmatched", "ambiguous")]
    return ["ok", "too_short", "no_library", "ambiguous_library", *per_bb, "umi_invalid"]


@dataclass
class DecodeTables:
    """What decoding needs of the library definitions, prepared once and reused by every join."""

    layouts: dict[Layout, list[str]]
    libraries: DataFrame
    library_lookup: DataFrame | None
    library_broadcast: bool
    bb_lookup: DataFrame
    bb_broadcast: bool
    library_sections: DataFrame
    building_blocks: DataFrame


def building_block_tables(library_sections: DataFrame, building_blocks: DataFrame, libraries: list[str], distance: int, strands: list[str]) -> DataFrame:
    """The stored lookup table of the libraries' building blocks, on the strands to be read."""
    # Each section has its own distance; the layout only knows the largest one of a library.
    own = library_sections.filter(F.col("kind") == "bb").select(
        F.col("library_id").alias("__lib"),
        F.regexp_extract("section", r"(\d+)$", 1).cast("int").alias("__cycle"),
        F.coalesce(F.regexp_extract("error_correction", r":\s*(\d+)", 1).try_cast("int"), F.lit(0)).alias("allowed"),
    )
    wanted = restrict_libraries(building_blocks, libraries).join(
        F.broadcast(own), (F.col("library_id") == F.col("__lib")) & (F.col("cycle") == F.col("__cycle"))
    )
    bb = on_strands(building_block_variants(wanted, distance), strands)
    return materialize(bb.withColumn("key", F.concat("strand", "library_id")), "bb-lookup")


def prepare_tables(
    library_sections: DataFrame,
    building_blocks: DataFrame,
    settings: DecodeSettings,
    broadcast_rows: int | None = None,
) -> DecodeTables:
    """Build and store the lookup tables and decide, from counted sizes, which are broadcast."""
    layouts = read_layouts(library_sections)
    if not layouts:
        raise ValueError("no library definitions")
    if settings.demultiplexer_mode == "single" and len(layouts) > 1:
        raise ValueError(
            f"{len(layouts)} different read layouts: set demultiplexer_mode='library'"
        )
    ids = [(n, lib) for n, layout in enumerate(layouts) for lib in layouts[layout]]
    libraries = library_sections.filter(F.col("kind") == "library").select("library_id", "tag")
    if len(layouts) == 1:
        libraries = libraries.withColumn("class_id", F.lit(0))
    else:
        spark = library_sections.sparkSession
        classes = spark.createDataFrame(ids, "class_id int, library_id string")
        libraries = libraries.join(classes, "library_id")
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    found = None
    if settings.demultiplexer_algorithm == "regex":
        found = materialize(
            on_strands(
                library_variants(
                    libraries, settings.library_error_tolerance, settings.min_library_overlap
                ),
                _strands(settings),
            ),
            "library-lookup",
        )
    bb = building_block_tables(
        library_sections, building_blocks, [lib for _, lib in ids], max(layout.distance for layout in layouts), _strands(settings)
    )
    return DecodeTables(
        layouts,
        libraries,
        found,
        found is not None and is_small(found, limit),
        bb,
        is_small(bb, limit),
        library_sections,
        building_blocks,
    )


def decode(
    reads: DataFrame,
    library_sections: DataFrame | None = None,
    building_blocks: DataFrame | None = None,
    settings: DecodeSettings | None = None,
    tables: DecodeTables | None = None,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Reads (selection_id, read_id, seq) to decoded reads, one row each."""
    settings = settings or DecodeSettings()
    if tables is None:
        tables = prepare_tables(library_sections, building_blocks, settings, broadcast_rows)
    layouts = tables.layouts
    reads = reads.select("selection_id", "read_id", "seq")
    if settings.demultiplexer_algorithm == "regex":
        called = call_library(
            reads, tables.library_lookup, list(layouts), settings, tables.library_broadcast
        )
    else:
        called = search_library(
            reads,
            tables.libraries,
            _strands(settings),
            settings.library_error_tolerance,
            settings.min_library_overlap,
        )
    if settings.library_indels == "YES":
        called = search_indels(called, tables.libraries, _strands(settings), settings.library_error_tolerance)
    called = with_anchor(end_span(called))
    if settings.demultiplexer_mode == "library":
        called = attach_layout(called, layouts)
    bbs, (umi_offset, umi_length) = _section_columns(layouts, settings)
    if settings.library_indels == "YES":
        bbs, umi_offset = after_called_end(bbs, umi_offset)
    for n, (cycle, (offset, length)) in enumerate(bbs.items()):
        if n and n % CYCLES_PER_SPAN == 0:
            called = end_span(called)
        called = call_building_blocks(
            called, tables.bb_lookup, cycle, offset, length, settings, tables.bb_broadcast
        )
    if settings.realign == "YES":
        called = realign_sections(called, tables.bb_lookup, bbs, settings, tables.bb_broadcast)
    if settings.section_indels == "YES":
        called = call_open_sections(called, tables.library_sections, tables.building_blocks, bbs, settings.shifts)

    if settings.demultiplexer_algorithm == "regex":
        shortest = min(
            layout.library_start + min(settings.shifts) + min(settings.min_library_overlap, layout.tag_length)
            for layout in layouts
        )
    else:
        shortest = settings.min_library_overlap
    single = settings.demultiplexer_mode == "single"
    present = {c: F.lit(True) if single else F.col(off).isNotNull() for c, (off, _) in bbs.items()}
    return finish(called, bbs, present, umi_offset, umi_length, F.coalesce(F.length("seq"), F.lit(0)) < shortest)


def finish(called: DataFrame, bbs: dict, present: dict, umi_offset, umi_length, too_short: Column, first: Column | None = None) -> DataFrame:
    """UMI, outcome and the columns of decoded reads; `first` is an outcome that goes before all others where it isn't null."""
    called = called.withColumn("__umi", _section(umi_offset, umi_length))
    umi_ok = F.expr(f"length(__umi) = {umi_length} AND NOT contains(__umi, 'N')")
    outcome = classify_outcome(
        too_short,
        F.col("library_id"),
        {c: (present[c], F.col(f"__bb{c}"), F.col(f"__amb{c}")) for c in bbs},
        umi_ok,
    )
    outcome = outcome if first is None else F.coalesce(first, outcome)
    lacks = F.lit(None).cast("string")
    strand = F.col("strand") if first is None else F.when(first.isNull(), F.col("strand")).otherwise(lacks)
    bb_ids = F.concat_ws(",", *[F.col(f"__bb{c}").cast("string") for c in bbs])
    staged = called.select(
        "selection_id",
        "read_id",
        strand.alias("strand"),
        F.nullif("library_id", F.lit(AMBIGUOUS)).alias("library_id"),
        bb_ids.alias("bb_ids"),
        "__umi",
        "lib_mismatches",
        outcome.alias("outcome"),
    )
    ok = F.col("outcome") == "ok"
    umi = F.when(F.col("strand") == "-", revcomp("__umi")).otherwise(F.col("__umi"))
    return staged.select(
        "selection_id",
        "read_id",
        "strand",
        "library_id",
        F.when(ok, F.col("bb_ids")).alias("bb_ids"),
        F.when(ok, umi).alias("umi"),
        "lib_mismatches",
        "outcome",
    )


def valid_reads(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("outcome") == "ok")
