"""Decoding many selections, each with its own libraries and settings, in one scan of the reads.

A group is a set of libraries with settings. Reads learn their group once, from a map of selections. The lookup table of
library tags carries the group in its key; the tables of building blocks depend on the library alone and serve all groups.
So a plan has as many joins as layouts, strands and shifts ask for, however many groups there are.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.dna import extract_section, hamming, strand_section
from tagloom.operators.decode import (
    DecodeSettings,
    _section_columns,
    _strands,
    after_called_end,
    attach_layout,
    best_candidate,
    building_block_tables,
    call_building_blocks,
    finish,
    realign_sections,
    with_anchor,
)
from tagloom.operators.indel_search import BLOCK_READS, TagIndex, find_tags
from tagloom.operators.layout import Layout, read_layouts
from tagloom.operators.search import COMPLEMENT, search_batch
from tagloom.operators.section_indels import call_open_sections
from tagloom.operators.variants import AMBIGUOUS, RANK_BITS, RANK_STEP, on_strands, substitution_variants
from tagloom.session import BROADCAST_ROWS, end_span, is_small, lookup, materialize

# Ship this module's functions inside the task, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Groups, not selections: the driver reads one row for each distinct combination of libraries and settings.
MAX_GROUPS = 100_000
GROUP = {"group": "__group", "plus": "__plus", "minus": "__minus", "anchored": "__anchored", "wiggle": "__wiggle", "realign": "__realign", "indels": "__indels", "shortest": "__shortest"}


@dataclass
class Group:
    """One combination: `libraries` are those with definitions."""

    number: int
    settings: DecodeSettings
    libraries: tuple[str, ...]
    shortest: int


@dataclass
class GroupTables:
    groups: list[Group]
    members: DataFrame
    layouts: dict[Layout, list[str]]
    library_lookup: DataFrame
    library_broadcast: bool
    bb_lookup: DataFrame
    bb_broadcast: bool
    tags: list[tuple[str, str]]
    library_sections: DataFrame
    building_blocks: DataFrame


def grouped_variants(tags: DataFrame, members: DataFrame, tolerance: int) -> DataFrame:
    """(group, class_id, obs) -> rank, library_id, as `library_variants` for each group by itself.

    The strings near a tag are made once; `members` (group, library_id, tolerance, overlap) says which of them count where.
    """
    least = members.groupBy(F.col("library_id").alias("lib")).agg(F.min("overlap").alias("least"))
    long = tags.filter(F.col("tag").isNotNull() & (F.length("tag") > 0)).join(F.broadcast(least), F.col("library_id") == F.col("lib"))
    prefixes = long.withColumn("n", F.explode(F.sequence(F.least("least", F.length("tag")), F.length("tag"))))
    prefixes = prefixes.select("class_id", "library_id", F.length("tag").alias("whole"), F.substr("tag", F.lit(1), F.col("n")).alias("tag"))
    near = substitution_variants(prefixes, tolerance).withColumn("mismatches", hamming("tag", "obs")).distinct()
    own = members.select("group", F.col("library_id").alias("lib"), "tolerance", "overlap")
    counted = (F.col("mismatches") <= F.col("tolerance")) & (F.length("obs") >= F.least("overlap", F.col("whole")))
    ranked = near.join(F.broadcast(own), (F.col("library_id") == F.col("lib")) & counted)
    ranked = ranked.withColumn("rank", F.col("mismatches") * RANK_STEP + (RANK_STEP - 1 - F.length("obs")))
    best = ranked.groupBy("group", "class_id", "obs").agg(
        F.min(F.struct("rank", "library_id")).alias("low"),
        F.max(F.struct((-F.col("rank")).alias("neg"), "library_id")).alias("high"),
    )
    unique = F.col("low.library_id") == F.col("high.library_id")
    return best.select("group", "class_id", "obs", F.col("low.rank").alias("rank"), F.when(unique, F.col("low.library_id")).otherwise(AMBIGUOUS).alias("library_id"))


def prepare_groups(selections: DataFrame, library_sections: DataFrame, building_blocks: DataFrame, broadcast_rows: int | None = None) -> GroupTables:
    """Groups of the selections and the lookup tables that serve all of them. A selection that names no libraries has all."""
    spark = selections.sparkSession
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    wanted = F.array_sort(F.array_distinct(F.coalesce("libraries", F.array().cast("array<string>"))))
    keyed = selections.select("selection_id", wanted.alias("libraries"), "decode_settings")
    keyed = keyed.withColumn("key", F.to_json(F.struct("libraries", "decode_settings"))).distinct()
    rows = keyed.dropDuplicates(["key"]).limit(MAX_GROUPS + 1).collect()
    if not rows:
        raise ValueError("no selections")
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} combinations of libraries and settings")
    layouts = read_layouts(library_sections)
    if not layouts:
        raise ValueError("no library definitions")
    layout_of = {lib: layout for layout, libs in layouts.items() for lib in libs}
    groups: dict[tuple, Group] = {}
    numbers: dict[str, int] = {}
    for row in sorted(rows, key=lambda r: r.key):
        settings = DecodeSettings.of(row.decode_settings.asDict() if row.decode_settings else None)
        libraries = tuple(lib for lib in (row.libraries or sorted(layout_of)) if lib in layout_of)
        own = {layout_of[lib] for lib in libraries}
        if not own:
            raise ValueError("no library definitions")
        if settings.demultiplexer_mode == "single" and len(own) > 1:
            raise ValueError(f"{len(own)} different read layouts: set demultiplexer_mode='library'")
        shortest = settings.min_library_overlap
        if settings.demultiplexer_algorithm == "regex":
            shortest = min(x.library_start + min(settings.shifts) + min(settings.min_library_overlap, x.tag_length) for x in own)
        found = groups.setdefault((settings, libraries), Group(len(groups), settings, libraries, shortest))
        numbers[row.key] = found.number
    listed = list(groups.values())
    flags = [
        (g.number, "+" in _strands(g.settings), "-" in _strands(g.settings), g.settings.demultiplexer_algorithm == "regex", g.settings.wiggle == "YES", g.settings.realign == "YES", g.settings.section_indels == "YES", g.shortest)
        for g in listed
    ]
    flag_rows = spark.createDataFrame(flags, "group int, plus boolean, minus boolean, anchored boolean, wiggle boolean, realign boolean, indels boolean, shortest int")
    by_key = spark.createDataFrame(list(numbers.items()), "key string, number int")
    joined = keyed.join(F.broadcast(by_key), "key").join(F.broadcast(flag_rows), F.col("number") == F.col("group"))
    members = materialize(joined.select("selection_id", *GROUP).distinct(), "groups")

    libraries = library_sections.filter(F.col("kind") == "library").select("library_id", "tag")
    classes = spark.createDataFrame([(n, lib) for n, x in enumerate(layouts) for lib in layouts[x]], "class_id int, library_id string")
    libraries = materialize(libraries.join(classes, "library_id"), "tags")
    anchored = [g for g in listed if g.settings.demultiplexer_algorithm == "regex"]
    rows = [(g.number, lib, g.settings.library_error_tolerance, g.settings.min_library_overlap) for g in anchored for lib in g.libraries]
    uses = spark.createDataFrame(rows, "group int, library_id string, tolerance int, overlap int")
    tolerance = max((g.settings.library_error_tolerance for g in anchored), default=0)
    found = materialize(on_strands(grouped_variants(libraries, uses, tolerance), ["+", "-"]), "library-lookup")
    bb = building_block_tables(library_sections, building_blocks, sorted(layout_of), max(x.distance for x in layouts), ["+", "-"])
    searched = any(g.settings.demultiplexer_algorithm != "regex" or g.settings.library_indels == "YES" for g in listed)
    tags = sorted((r.library_id, r.tag) for r in libraries.filter(F.length("tag") > 0).collect()) if searched else []
    return GroupTables(listed, members, layouts, found, is_small(found, limit), bb, is_small(bb, limit), tags, library_sections, building_blocks)


def _call_anchored(reads: DataFrame, tables: GroupTables) -> DataFrame:
    """The library call of `call_library`, for the rows whose group asks for it, on the strands and shifts it allows."""
    out = reads
    found: dict[str, list] = {"+": [], "-": []}
    for class_id, layout in enumerate(tables.layouts):
        out = end_span(out) if class_id else out
        for strand, flag in (("+", "__plus"), ("-", "__minus")):
            table = tables.library_lookup.filter((F.col("class_id") == class_id) & (F.col("strand") == strand))
            for shift in (-1, 0, 1):
                at = layout.library_start + shift
                if at < 0:
                    continue
                if strand == "+":
                    window = extract_section("seq", at, layout.tag_length)
                else:
                    window = strand_section("seq", f"length(seq) - {at}", "-1", "0", 0, layout.tag_length)
                asked = F.col("__anchored") & F.col(flag)
                asked = asked & F.col("__wiggle") if shift else asked
                name = f"{strand}{class_id}_{shift}"
                keys = {"group": F.col("__group"), "obs": F.when(asked, window)}
                out = lookup(out, table, keys, {"rank": f"__r{name}", "library_id": f"__l{name}"}, tables.library_broadcast, spread=F.col("read_id"))
                found[strand].append((at, F.col(f"__r{name}"), F.col(f"__l{name}")))
    calls = {}
    for strand, candidates in found.items():
        rank, library, pos = best_candidate([(r, lib, F.lit(at)) for at, r, lib in sorted(candidates, key=lambda c: c[0])])
        calls.update({f"__rank{strand}": rank, f"__lib{strand}": library, f"__pos{strand}": pos})
    out = out.select(*reads.columns, *[c.alias(n) for n, c in calls.items()])
    mismatches = {s: F.shiftright(F.col(f"__rank{s}"), RANK_BITS) for s in "+-"}
    far = F.lit(1 << 20)
    reverse = F.when(F.col("__plus"), F.coalesce(mismatches["-"], far) < F.coalesce(mismatches["+"], far)).otherwise(F.coalesce("__minus", F.lit(False)))
    pick = lambda minus, plus: F.when(reverse, minus).otherwise(plus)
    return out.select(
        *reads.columns,
        F.when(reverse, "-").otherwise("+").alias("strand"),
        pick(F.col("__lib-"), F.col("__lib+")).alias("library_id"),
        pick(F.col("__pos-"), F.col("__pos+")).alias("lib_pos"),
        pick(mismatches["-"], mismatches["+"]).alias("lib_mismatches"),
    )


def _call_searched(called: DataFrame, tables: GroupTables) -> DataFrame:
    """The search over all positions for the groups that ask for it, and the search with indels for their open reads."""
    answer = {"strand": T.StringType(), "library_id": T.StringType(), "lib_pos": T.IntegerType(), "lib_mismatches": T.IntegerType(), "lib_surplus": T.IntegerType()}
    called = called.withColumn("lib_surplus", F.lit(None).cast("int"))
    names = called.columns
    schema = T.StructType([T.StructField(f.name, answer.get(f.name, f.dataType)) for f in called.schema.fields])
    tags = dict(tables.tags)
    jobs = {
        g.number: (g.settings, [(lib, tags[lib]) for lib in g.libraries if lib in tags])
        for g in tables.groups
        if g.settings.demultiplexer_algorithm != "regex" or g.settings.library_indels == "YES"
    }

    def kernel(batches):
        indexes: dict[int, TagIndex] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_READS):
                yield search(batch.slice(lo, BLOCK_READS), indexes)

    def search(batch: pa.RecordBatch, indexes: dict) -> pa.RecordBatch:
        columns = dict(zip(names, batch.columns))
        group = columns["__group"].fill_null(-1).to_numpy(zero_copy_only=False)
        asked = [int(g) for g in np.unique(group) if g in jobs]
        if not asked:
            return batch
        values = {c: np.array(columns[c].to_pylist(), dtype=object) for c in answer}
        for g in asked:
            settings, own = jobs[g]
            rows = np.flatnonzero(group == g)
            forward = [(s or "").encode() for s in columns["seq"].take(pa.array(rows)).to_pylist()]
            strands = _strands(settings)
            if settings.demultiplexer_algorithm != "regex":
                encoded = [(lib, t.encode()) for lib, t in own]
                take(values, rows, strands, forward, lambda s: (*search_batch(s, encoded, settings.library_error_tolerance, settings.min_library_overlap), None))  # noqa: B023
            if settings.library_indels == "YES":
                index = indexes.setdefault(g, None) or TagIndex(own, settings.library_error_tolerance)
                indexes[g] = index
                left = np.flatnonzero(values["library_id"][rows] == None)  # noqa: E711
                if len(left):
                    take(values, rows[left], strands, [forward[i] for i in left], lambda s: nearest(index, s))  # noqa: B023
        fresh = {c: pa.array(v.tolist(), pa.string() if c in ("strand", "library_id") else pa.int32()) for c, v in values.items()}
        return pa.RecordBatch.from_arrays([fresh.get(c, columns[c]) for c in names], names=names)

    def nearest(index: TagIndex, seqs: list[bytes]) -> tuple:
        distance, tag, start, _, surplus = find_tags(index, seqs)
        library = np.array([None if x < 0 else index.names[t] if t >= 0 else AMBIGUOUS for x, t in zip(distance, tag)], dtype=object)
        return distance, library, start, surplus

    def take(values: dict, rows: np.ndarray, strands: list[str], forward: list[bytes], work) -> None:
        best = np.full(len(rows), -1, dtype=np.int64)
        values["strand"][rows] = strands[0]
        for strand in strands:
            distance, library, place, surplus = work(forward if strand == "+" else [s[::-1].translate(COMPLEMENT) for s in forward])
            better = (distance >= 0) & ((best < 0) | (distance < best))
            at = rows[better]
            values["strand"][at], values["library_id"][at] = strand, library[better]
            values["lib_pos"][at], values["lib_mismatches"][at] = place[better], distance[better]
            if surplus is not None:
                values["lib_surplus"][at] = surplus[better]
            best = np.where(better, distance, best)

    return called.mapInArrow(kernel, schema)


def decode_groups(reads: DataFrame, tables: GroupTables, unlisted: str) -> DataFrame:
    """Reads (selection_id, read_id, seq) to decoded reads, each by the group of its selection; others get the outcome `unlisted`.

    A selection listed with several combinations has its reads decoded by each. Null selections are unlisted.
    """
    listed = lookup(
        reads.select("selection_id", "read_id", "seq"), tables.members, {"selection_id": F.col("selection_id")}, GROUP, is_small(tables.members), spread=F.col("read_id")
    )
    called = _call_anchored(listed, tables)
    indels = any(g.settings.library_indels == "YES" for g in tables.groups)
    if tables.tags:
        called = _call_searched(called, tables)
    called = with_anchor(end_span(called))
    called = attach_layout(called, tables.layouts)
    settings = DecodeSettings.of(revcomp="BOTH", demultiplexer_mode="library")
    bbs, (umi_offset, umi_length) = _section_columns(tables.layouts, settings)
    if indels:
        bbs, umi_offset = after_called_end(bbs, umi_offset)
    for n, (cycle, (offset, length)) in enumerate(bbs.items()):
        called = end_span(called) if n else called
        called = call_building_blocks(called, tables.bb_lookup, cycle, offset, length, settings, tables.bb_broadcast, wiggle="__wiggle")
    if any(g.settings.realign == "YES" for g in tables.groups):
        called = realign_sections(called, tables.bb_lookup, bbs, settings, tables.bb_broadcast, "__realign", "__wiggle")
    if any(g.settings.section_indels == "YES" for g in tables.groups):
        for wiggle in {g.settings.wiggle for g in tables.groups if g.settings.section_indels == "YES"}:
            only = f"__indels AND __wiggle = {'true' if wiggle == 'YES' else 'false'}"
            called = call_open_sections(called, tables.library_sections, tables.building_blocks, bbs, DecodeSettings.of(wiggle=wiggle).shifts, only)
    present: dict[int, Column] = {c: F.col(f"__off{c}").isNotNull() for c in bbs}
    return finish(called, bbs, present, umi_offset, umi_length, F.coalesce(F.length("seq"), F.lit(0)) < F.col("__shortest"), F.when(F.col("__group").isNull(), unlisted))
