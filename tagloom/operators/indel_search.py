"""Library tags anywhere in a read, with substitutions, insertions and deletions.

A tag at edit distance <= t from a stretch of the read holds at least one of its t + 1 pieces unchanged. So each place of a
read is looked up in a table of pieces (one look per piece length, whatever the number of tags), a filter on packed bases
drops chance hits, and Myers' bit-parallel edit distance (1999) settles the rest. All steps are array operations over the
reads of a batch that are still without a library; the others pass untouched.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators.variants import AMBIGUOUS
from tagloom.session import materialize

# Ship this module's functions inside the task, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Counted bytes of names and tags up to which the piece table is made from a copy in each task; more are searched in blocks.
TAG_BYTES = 16 << 20
# Bases of a piece that are looked up; longer pieces are known by their first ones.
SEED_BASES = 11
# Bases of a tag that the filter compares; two bits a base.
PACKED_BASES = 31
BLOCK_READS = 2048
BLOCK_HITS = 1 << 15
OTHER = 4
CODE = np.full(256, OTHER, dtype=np.uint8)
for _i, _base in enumerate(b"ACGT"):
    CODE[_base] = _i
LANES = np.uint64(0x5555555555555555)


class TagIndex:
    """Pieces of the tags by length, and what the filter and the verifier need of each tag."""

    def __init__(self, tags: list[tuple[str, str]], tolerance: int):
        self.tolerance = tolerance
        self.names = [n for n, _ in tags]
        self.codes = [CODE[np.frombuffer(t.encode(), dtype=np.uint8)] for _, t in tags]
        self.length = np.array([len(c) for c in self.codes], dtype=np.int64)
        if len(tags) and self.length.min() <= tolerance:
            raise ValueError("a library tag must be longer than the tolerance")
        self.packed = np.array([self._pack(c[:PACKED_BASES]) for c in self.codes], dtype=np.uint64)
        self.words = int(-(-max(self.length, default=1) // 64))
        self.equal = np.zeros((self.words, len(tags), OTHER + 1), dtype=np.uint64)
        self.equal_back = np.zeros_like(self.equal)
        seeds: dict[int, list[tuple[int, int, int]]] = {}
        for t, code in enumerate(self.codes):
            for j, c in enumerate(code.tolist()):
                if c < OTHER:
                    back = len(code) - 1 - j
                    self.equal[j // 64, t, c] |= np.uint64(1 << (j % 64))
                    self.equal_back[back // 64, t, c] |= np.uint64(1 << (back % 64))
            cuts = [len(code) * i // (tolerance + 1) for i in range(tolerance + 2)]
            for a, b in zip(cuts, cuts[1:]):
                piece = code[a : min(b, a + SEED_BASES)]
                if (piece < OTHER).all():  # a base that can't be read matches nothing, so its piece is never found whole
                    seeds.setdefault(len(piece), []).append((int(self._pack(piece)), t, a))
        self.seeds = {}
        for q, rows in seeds.items():
            value, tag, offset = np.array(sorted(rows), dtype=np.int64).T
            first = np.searchsorted(value, np.arange(4**q + 1))
            self.seeds[q] = first.astype(np.int32), tag, offset

    @staticmethod
    def _pack(code: np.ndarray) -> int:
        value = 0
        for c in code.tolist():
            value = value << 2 | (c & 3)
        return value


def _rolling(bases: np.ndarray, q: int) -> np.ndarray:
    """At each place the next `q` bases, two bits each; other characters count as A."""
    two = (bases & 3).astype(np.uint64) * (bases < OTHER)
    out = np.zeros(len(bases), dtype=np.uint64)
    for j in range(q):
        out[: len(bases) - j] |= two[j:] << np.uint64(2 * (q - 1 - j))
    return out


def seed_hits(index: TagIndex, bases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tag, place where the tag would begin without indels before the piece) of every whole piece in the bases."""
    tags, places = [], []
    bad = np.concatenate([[0], np.cumsum(bases >= OTHER)])
    for q, (first, tag, offset) in index.seeds.items():
        n = len(bases) - q + 1
        if n <= 0:
            continue
        at = np.flatnonzero(bad[q:] == bad[:n])
        code = _rolling(bases, q)[at].astype(np.int64)
        lo = first[code]
        many = first[code + 1] - lo
        some = many > 0
        at, lo, many = at[some], lo[some], many[some]
        row = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        tags.append(tag[row])
        places.append(np.repeat(at, many) - offset[row])
    if not tags:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(tags), np.concatenate(places)


def likely(index: TagIndex, window: np.ndarray, pad: int, tag: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Hits that can be within the tolerance t; never false for one that is.

    An alignment with t edits is at most t + 1 runs of equal bases on diagonals within t of the hit's. Bases in runs of
    three or more on any of these diagonals are covered; shorter runs and edits leave at most t + 2 (t + 1) bases uncovered.
    Compared are the first PACKED_BASES bases.
    """
    t = index.tolerance
    if not len(tag):
        return np.zeros(0, dtype=bool)
    k = np.minimum(index.length[tag], PACKED_BASES)
    own = index.packed[tag]
    drop = (2 * (PACKED_BASES - k)).astype(np.uint64)
    used = LANES & ((np.uint64(1) << (2 * k).astype(np.uint64)) - np.uint64(1))
    covered = np.zeros(len(tag), dtype=np.uint64)
    for shift in range(-t, t + 1):
        x = (window[place + (shift + pad)] >> drop) ^ own
        same = ~(x | x >> np.uint64(1)) & used
        run = same & (same >> np.uint64(2)) & (same >> np.uint64(4))
        covered |= run | run << np.uint64(2) | run << np.uint64(4)
    return np.bitwise_count(used & ~covered) <= 3 * t + 2


def myers(equal: np.ndarray, length: np.ndarray, tag: np.ndarray, text: np.ndarray, start: np.ndarray, steps: int, free: bool) -> np.ndarray:
    """Edit distance of whole tags to stretches of `text`, for each hit and each number of bases read: (steps + 1, hits).

    `free`: a stretch may begin anywhere, else at the first base. Words of 64 bits are chained, so tags have any length.
    """
    words, _, letters = equal.shape
    n = len(tag)
    plus = np.full((words, n), ~np.uint64(0))
    minus = np.zeros((words, n), dtype=np.uint64)
    score = length[tag].astype(np.int64)
    out = np.empty((steps + 1, n), dtype=np.int64)
    out[0] = score
    last, top = (length[tag] - 1) // 64, ((length[tag] - 1) % 64).astype(np.uint64)
    one = np.uint64(1)
    high = np.uint64(63)
    table = equal.reshape(words, -1)
    for s in range(steps):
        cell = tag * letters + text[start + s]
        carry_plus = np.full(n, np.uint64(0 if free else 1))
        carry_minus = np.zeros(n, dtype=np.uint64)
        for w in range(words):
            p, m = plus[w], minus[w]
            eq = table[w][cell]
            xv = eq | m
            eq |= carry_minus
            xh = (((eq & p) + p) ^ p) | eq
            ph = m | ~(xh | p)
            mh = p & xh
            if words == 1:
                score = score + ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64)
            else:
                here = last == w
                step = ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64)
                score = score + np.where(here, step, 0)
            out_plus, out_minus = ph >> high, mh >> high
            ph = ph << one | carry_plus
            mh = mh << one | carry_minus
            plus[w] = mh | ~(xv | ph)
            minus[w] = ph & xv
            carry_plus, carry_minus = out_plus, out_minus
        out[s + 1] = score
    return out


def find_tags(index: TagIndex, seqs: list[bytes]) -> tuple[np.ndarray, ...]:
    """Per read: distance (-1: none), tag (-1: several libraries at that distance), start, end and surplus bases of the tag in the read.

    The place is the leftmost end at the least distance; of the stretches that end there the one whose length is nearest
    to the tag's, then the shorter.
    """
    t = index.tolerance
    n = len(seqs)
    distance, best_tag = np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    start, end, surplus = (np.zeros(n, dtype=np.int64) for _ in range(3))
    if not index.names or not n:
        return distance, best_tag, start, end, surplus
    longest = int(index.length.max())
    # Reads end to end, with more unreadable bases between them than there may be edits.
    gap = bytes(t + 1)
    lengths = np.array([len(s) for s in seqs], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(lengths + t + 1)])[:-1]
    bases = CODE[np.frombuffer(gap.join(seqs) + gap, dtype=np.uint8)]
    pad = longest + 3 * t + PACKED_BASES + 1
    padded = np.concatenate([np.full(pad, OTHER, np.uint8), bases, np.full(pad, OTHER, np.uint8)])
    tag, place = seed_hits(index, bases)
    keep = likely(index, _rolling(padded, PACKED_BASES), pad, tag, place)
    tag, place = tag[keep], place[keep]
    found: list[tuple] = []
    for lo in range(0, len(tag), BLOCK_HITS):
        some, at = tag[lo : lo + BLOCK_HITS], place[lo : lo + BLOCK_HITS]
        order = np.argsort(index.length[some], kind="stable")
        some, at = some[order], at[order]
        cuts = np.flatnonzero(np.diff(index.length[some], prepend=-1, append=-1))
        for a, b in zip(cuts, cuts[1:]):
            k = int(index.length[some[a]])
            score = myers(index.equal, index.length, some[a:b], padded, at[a:b] + pad - t, k + 2 * t, True)
            low = score.min(axis=0)
            good = np.flatnonzero(low <= t)
            found.append((low[good], some[a:b][good], at[a:b][good] - t + score[:, good].argmin(axis=0)))
    if not found:
        return distance, best_tag, start, end, surplus
    low, tag, stop = (np.concatenate(c) for c in zip(*found))
    read = np.searchsorted(begin, stop - 1, side="right") - 1
    order = np.lexsort((stop, tag, low, read))
    low, tag, stop, read = low[order], tag[order], stop[order], read[order]
    first = np.flatnonzero(np.diff(read, prepend=-1))
    best = low[first]
    level = np.repeat(best, np.diff(np.append(first, len(read)))) == low
    # Several tags of one library don't make a read ambiguous.
    name = np.unique(np.array(index.names, dtype=object).astype(str), return_inverse=True)[1]
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(read))))
    least, most = np.full(len(first), len(name)), np.full(len(first), -1)
    np.minimum.at(least, group[level], name[tag[level]])
    np.maximum.at(most, group[level], name[tag[level]])
    at_end = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(at_end, group[level], stop[level])
    # Among the tags at the least distance, the one that ends first; then the first tag.
    chosen = np.lexsort((tag, stop, ~level, group))
    chosen = chosen[np.flatnonzero(np.diff(group[chosen], prepend=-1))]
    tag, stop, read = tag[chosen], stop[chosen], read[chosen]
    backward = padded[::-1]
    reach = longest + t
    back = myers(index.equal_back, index.length, tag, backward, len(padded) - (stop + pad), reach, False)
    room = stop - begin[read]
    taken = np.arange(reach + 1)[:, None]
    rank = np.where((back == best) & (taken <= room), 2 * np.abs(taken - index.length[tag]) + (taken > index.length[tag]), 1 << 30)
    size = rank.argmin(axis=0)
    distance[read], best_tag[read] = best, np.where(least == most, tag, -1)
    end[read], start[read], surplus[read] = room, room - size, size - index.length[tag]
    return distance, best_tag, start, end, surplus


def _blocks(libraries: DataFrame, limit: int) -> list[list[tuple[str, str]]]:
    """The tags in blocks of at most `limit` bytes, each fetched by itself."""
    tags = libraries.filter(F.length("tag") > 0).select("library_id", "tag").distinct()
    tags = materialize(tags.withColumn("bytes", F.octet_length("library_id") + F.octet_length("tag")), "tags")
    total, most = tags.agg(F.sum("bytes"), F.max("bytes")).head()
    n = -(-(total or 0) // limit) if total else 0
    if n > 1:  # blocks by hash, so each is somewhat smaller than the limit
        n = -(-total // max(1, limit - 4 * most))
    parts = [tags.filter(F.pmod(F.xxhash64("tag", "library_id"), F.lit(n)) == i) if n > 1 else tags for i in range(n)]
    return [sorted((r.library_id, r.tag) for r in p.select("library_id", "tag").collect()) for p in parts]


def search_indels(called: DataFrame, libraries: DataFrame, strands: list[str], tolerance: int = 2, tag_bytes: int = TAG_BYTES) -> DataFrame:
    """Library, place and distance for the rows of `called` whose library_id is null; the others stay as they are.

    Takes and gives the columns of the anchored call (strand, library_id, lib_pos, lib_mismatches) and adds lib_end, the
    end of the tag on its strand, both null where it was called before. The least distance wins, forward on a tie of strands; two libraries at it are
    AMBIGUOUS. lib_surplus is how many bases the stretch has more than the tag. Whole tags only: those cut by a read end are the anchored call's. Null and empty reads stay open.
    """
    no_place = F.lit(None).cast("int")
    out = called.withColumns({"lib_end": no_place, "lib_surplus": no_place})
    blocks = _blocks(libraries, tag_bytes)
    # A read that an earlier block called is searched again: another block may hold a nearer tag, or one as near.
    out = out.withColumn("open__", F.col("library_id").isNull())
    for tags in blocks:
        out = _search_block(out, tags, strands, tolerance)
    return out.drop("open__")


def _search_block(called: DataFrame, tags: list[tuple[str, str]], strands: list[str], tolerance: int) -> DataFrame:
    schema = called.schema
    answer = {"strand": T.StringType(), "library_id": T.StringType(), "lib_pos": T.IntegerType(), "lib_end": T.IntegerType(), "lib_surplus": T.IntegerType(), "lib_mismatches": T.IntegerType()}
    names = schema.names
    schema = T.StructType([T.StructField(f.name, answer.get(f.name, f.dataType)) for f in schema.fields])
    complement = bytes.maketrans(b"ACGT", b"TGCA")

    def kernel(batches):
        index = TagIndex(tags, tolerance)
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_READS):
                yield search(index, batch.slice(lo, BLOCK_READS))

    def search(index: TagIndex, batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = dict(zip(names, batch.columns))
        open_ = np.flatnonzero(columns["open__"].to_numpy(zero_copy_only=False))
        if not len(open_):
            return batch
        seqs = [(s or "").encode() for s in columns["seq"].take(pa.array(open_)).to_pylist()]
        texts = {c: np.array(columns[c].to_pylist(), dtype=object) for c in ("strand", "library_id")}
        numbers = {c: pc.fill_null(columns[c], 0).to_numpy(zero_copy_only=False).copy() for c in answer if c not in texts}
        lacks = {c: columns[c].is_null().to_numpy(zero_copy_only=False).copy() for c in numbers}
        best = np.where(lacks["lib_mismatches"][open_], -1, numbers["lib_mismatches"][open_]).astype(np.int64)
        found_names = np.array([*index.names, AMBIGUOUS], dtype=object)  # the last one is that of tag -1
        for strand in strands:
            sides = seqs if strand == "+" else [s[::-1].translate(complement) for s in seqs]
            distance, tag, start, end, surplus = find_tags(index, sides)
            name = found_names[tag]
            better = (distance >= 0) & ((best < 0) | (distance < best))
            # As near as what an earlier block found on this strand, but another library.
            level = (distance >= 0) & (distance == best) & (texts["strand"][open_] == strand) & (texts["library_id"][open_] != name)
            texts["library_id"][open_[level]] = AMBIGUOUS
            texts["strand"][open_[better]], texts["library_id"][open_[better]] = strand, name[better]
            moved = better | (level & (end < numbers["lib_end"][open_]))
            for c, v in (("lib_pos", start), ("lib_end", end), ("lib_surplus", surplus), ("lib_mismatches", distance)):
                numbers[c][open_[moved]], lacks[c][open_[moved]] = v[moved], False
            best = np.where(better, distance, best)
        fresh = {c: pa.array(v, pa.string()) for c, v in texts.items()} | {c: pa.array(v, pa.int32(), mask=lacks[c]) for c, v in numbers.items()}
        return pa.RecordBatch.from_arrays([fresh.get(c, columns[c]) for c in names], names=names)

    return called.mapInArrow(kernel, schema)
