"""Building blocks whose section lost or gained bases, for the reads that the lookup of equal-length windows left open.

Two strings within d edits become equal when each loses at most d characters (symmetric deletion, Garbe 2012). So an index
holds every tag with up to d characters deleted, about len(tag) entries a level, and a window is looked up by its own
deletions. Windows of len - d to len + d bases are tried at the place of the section; what a section has too much or too
little moves the sections behind it, seen from the library tag.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.session import materialize

# Ship this module's functions inside the task, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Index entries of all tags up to which every task gets the whole index; with more, open reads go to their library's tags.
INDEX_ENTRIES = 500_000
# Open reads of one library that meet its tags in one task.
READS_PER_TASK = 200_000
# Windows that the index of a library remembers in a task, at most.
SEEN_WINDOWS = 50_000
COMPLEMENT = str.maketrans("ACGT", "TGCA")


def deletions(text: str, most: int) -> Iterator[str]:
    """The text with up to `most` characters left out; repeats may come twice."""
    n = len(text)
    for gone in range(min(most, n) + 1):
        for kept in combinations(range(n), n - gone):
            yield "".join([text[i] for i in kept])


def edit_distance(a: str, b: str) -> int:
    """Bit-parallel (Myers 1999, Hyyro 2003): a column of the table is two integers."""
    if a == b or not a:
        return len(b) if not a else 0
    masks: dict[str, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full, last, distance = (1 << len(a)) - 1, 1 << len(a) - 1, len(a)
    up, down = full, 0
    for y in b:
        eq = masks.get(y, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right, left = down | ~(diagonal | up), up & diagonal
        if right & last:
            distance += 1
        elif left & last:
            distance -= 1
        right = right << 1 | 1
        up, down = (left << 1 | ~(diagonal | right)) & full, right & diagonal & full
    return distance


class SectionIndex:
    """Tags of one library by cycle: deleted forms, and the distance that the section allows."""

    def __init__(self, rows: list[tuple[int, int, str, int]]):
        self.forms: dict[int, dict[str, list[tuple[int, str]]]] = {}
        self.allowed: dict[int, int] = {}
        self.seen: dict[tuple[int, str], list[tuple[int, int]]] = {}
        for cycle, number, tag, allowed in rows:
            self.allowed[cycle] = allowed
            forms = self.forms.setdefault(cycle, {})
            for form in set(deletions(tag, allowed)):
                forms.setdefault(form, []).append((number, tag))

    def near(self, cycle: int, window: str) -> list[tuple[int, int]]:
        """(distance, id) of the tags within the allowed distance of the window. Windows met before are remembered."""
        known = self.seen.get((cycle, window))
        if known is not None:
            return known
        most, forms = self.allowed[cycle], self.forms[cycle]
        tags = {found for form in set(deletions(window, most)) for found in forms.get(form, ())}
        if len(self.seen) >= SEEN_WINDOWS:
            self.seen.clear()
        found = self.seen[cycle, window] = [(d, number) for number, tag in tags if (d := edit_distance(tag, window)) <= most]
        return found


def walk(seq: str, lib_pos: int, surplus: int, sections: list[tuple[int, int, int]], calls: dict, index: SectionIndex, shifts: tuple[int, ...]) -> None:
    """Call the open sections of one read (on the strand of its library tag), from the library tag outwards on either side.

    `sections`: (cycle, offset from the library tag, length); `calls`: cycle -> [id, ambiguous, shift], changed in place. A
    section begins where the ones nearer to the tag say. The first shift with one tag at the least distance wins;
    that tag's window is the one nearest to the section's length, the shorter of two.
    """
    left = sorted((s for s in sections if s[1] < 0), key=lambda s: -s[1])
    right = sorted((s for s in sections if s[1] >= 0), key=lambda s: s[1])
    for side, moved in ((left, 0), (right, surplus)):
        for cycle, offset, length in side:
            number, ambiguous, shift = calls[cycle]
            if number is not None:
                moved = shift + (surplus if side is right else 0)
                continue
            if cycle not in index.forms:
                continue
            most = index.allowed[cycle]
            sizes = sorted(range(max(1, length - most), length + most + 1), key=lambda n: (abs(n - length), n))
            for s in shifts:
                found: list[tuple[int, int, int]] = []
                for rank, n in enumerate(sizes):
                    at = lib_pos + offset + moved + s + (length - n if side is left else 0)
                    if at >= 0 and at + n <= len(seq):
                        found += [(d, rank, i) for d, i in index.near(cycle, seq[at : at + n])]
                if not found:
                    continue
                least = min(found)[0]
                ids = {i for d, _, i in found if d == least}
                if len(ids) > 1:
                    ambiguous = True
                    continue
                extra = sizes[min(r for d, r, _ in found if d == least)] - length
                moved += s - extra if side is left else s + extra
                number = ids.pop()
                break
            calls[cycle] = [number, ambiguous, None if number is None else moved]


def call_open_sections(
    called: DataFrame, library_sections: DataFrame, building_blocks: DataFrame, sections: dict, shifts: tuple[int, ...], only: str = "true", limit: int | None = None
) -> DataFrame:
    """Second look at uncalled sections of reads with a library, with windows of changing length.

    `called` holds seq, strand, library_id, lib_pos and __bb<i>, __amb<i>, __sh<i> of each cycle; `sections` maps cycles to
    (offset, length), numbers or columns. Reads that need no second look pass untouched. The tags are shipped to every task
    while their counted index entries stay below `limit`; beyond, only the open reads are shuffled, once, to the tags of
    their library, a large library's reads to several tasks.
    """
    limit = INDEX_ENTRIES if limit is None else limit
    own = library_sections.filter(F.col("kind") == "bb").select(
        F.col("library_id").alias("__lib"),
        F.regexp_extract("section", r"(\d+)$", 1).cast("int").alias("__cycle"),
        F.coalesce(F.regexp_extract("error_correction", r":\s*(\d+)", 1).try_cast("int"), F.lit(0)).alias("allowed"),
    )
    same = (F.col("library_id") == F.col("__lib")) & (F.col("cycle") == F.col("__cycle"))
    tags = building_blocks.filter(F.length("tag") > 0).join(F.broadcast(own), same).select("library_id", "cycle", "id", "tag", "allowed")
    # Entries of a tag of n bases at distance d: no more than the sum of n over k, up to d.
    size = F.aggregate(F.sequence(F.lit(0), F.col("allowed")), F.lit(0.0), lambda acc, k: acc + F.pow(F.length("tag"), k))
    tags = materialize(tags.withColumn("entries", size), "section-tags")
    entries = tags.agg(F.sum("entries")).first()[0] or 0

    cycles = sorted(sections)
    places = {f"__at{c}": F.expr(str(sections[c][0])).cast("int") for c in cycles} | {f"__n{c}": F.expr(str(sections[c][1])).cast("int") for c in cycles}
    surplus = F.coalesce("lib_surplus", F.lit(0)) if "lib_surplus" in called.columns else F.lit(0)
    missing = " OR ".join(f"(__bb{c} IS NULL AND __at{c} IS NOT NULL)" for c in cycles)
    rows = called.withColumns({**places, "__extra": surplus.cast("int")})
    rows = rows.withColumn("__open", F.coalesce(F.expr(f"lib_pos IS NOT NULL AND ({missing}) AND {only}"), F.lit(False)))
    names = rows.columns
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])

    def second_look(batch: pa.RecordBatch, indexes: dict[str, SectionIndex]) -> pa.RecordBatch:
        columns = dict(zip(names, batch.columns))
        open_ = np.flatnonzero(columns["__open"].to_numpy(zero_copy_only=False)).tolist()
        if not open_:
            return batch
        values = {c: columns[c].to_pylist() for c in names if c.startswith(("__bb", "__amb", "__sh"))}
        of = {c: columns[c].to_pylist() for c in ("seq", "strand", "library_id", "lib_pos", "__extra")}
        spots = {c: (columns[f"__at{c}"].to_pylist(), columns[f"__n{c}"].to_pylist()) for c in cycles}
        for i in open_:
            index = indexes.get(of["library_id"][i])
            if index is None:
                continue
            seq = of["seq"][i] if of["strand"][i] == "+" else of["seq"][i][::-1].translate(COMPLEMENT)
            # Offsets behind the tag have its surplus in them already; the walk adds it itself.
            here = [(c, at[i] - (of["__extra"][i] if at[i] > 0 else 0), n[i]) for c, (at, n) in spots.items() if at[i] is not None]
            calls = {c: [values[f"__bb{c}"][i], values[f"__amb{c}"][i], values[f"__sh{c}"][i]] for c in cycles}
            walk(seq, of["lib_pos"][i], of["__extra"][i], here, calls, index, shifts)
            for c, (number, ambiguous, shift) in calls.items():
                values[f"__bb{c}"][i], values[f"__amb{c}"][i], values[f"__sh{c}"][i] = number, ambiguous, shift
        kinds = {f.name: f.type for f in batch.schema}
        return pa.RecordBatch.from_arrays([pa.array(values[c], kinds[c]) if c in values else columns[c] for c in names], names=names)

    def indexed(found: list[tuple]) -> dict[str, SectionIndex]:
        by_library: dict[str, list] = {}
        for library, *row in found:
            by_library.setdefault(library, []).append(tuple(row))
        return {library: SectionIndex(r) for library, r in by_library.items()}

    extra = ["__open", "__extra", *places]
    if entries <= limit:
        listed = [tuple(r) for r in tags.select("library_id", "cycle", "id", "tag", "allowed").collect()]

        def kernel(batches):
            indexes = None
            for batch in batches:
                indexes = indexes or indexed(listed)
                yield second_look(batch, indexes)

        return rows.mapInArrow(kernel, schema).drop(*extra)

    rows = materialize(rows, "called")
    waiting = rows.filter("__open")
    parts = materialize(waiting.groupBy("library_id").agg(F.ceil(F.count(F.lit(1)) / READS_PER_TASK).cast("int").alias("parts")), "open-libraries")
    parts = F.broadcast(parts.withColumnsRenamed({"library_id": "__lib"}))  # one row a library
    spread = waiting.join(parts, F.col("library_id") == F.col("__lib")).withColumn("__part", F.pmod(F.xxhash64("seq", "read_id"), F.col("parts")).cast("int")).drop("__lib", "parts")
    copies = tags.join(parts, F.col("library_id") == F.col("__lib"))
    copies = copies.select(F.col("library_id").alias("__lib"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("__copy"), "cycle", "id", "tag", "allowed")

    def together(reads: pa.Table, own: pa.Table) -> pa.Table:
        indexes = indexed([(r["__lib"], r["cycle"], r["id"], r["tag"], r["allowed"]) for r in own.to_pylist()])
        found = [second_look(b, indexes) for b in reads.select(names).combine_chunks().to_batches()]
        return pa.Table.from_batches(found) if found else reads.select(names)

    looked = spread.groupBy("library_id", "__part").cogroup(copies.groupBy("__lib", "__copy")).applyInArrow(together, schema)
    return rows.filter("NOT __open").unionByName(looked).drop(*extra)
