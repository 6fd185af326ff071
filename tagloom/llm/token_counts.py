"""Token counts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.pieces import HEAP_LENGTH, NO_PAIR, PieceTable, default_path, merge_one, piece_table, units_of
from tagloom.llm.texts import as_text

# Units whose counts a task remembers; it forgets all of them beyond that. Bounds memory, changes no result.
REMEMBERED_UNITS = 400_000
# Characters of new units merged at a time.
MERGE_CHARS = 1 << 19


def merge_counts(vocabulary: PieceTable, units: list[str]) -> np.ndarray:
    """Number of tokens of each unit.

    All units are held as one ragged array. In each round every unit applies its best-ranked pair: everywhere it
    occurs, from the left, or at its leftmost place where the merged piece could make a better pair. Units without
    a pair left are counted and leave. A character outside the vocabulary counts as its UTF-8 bytes.
    """
    out = np.zeros(len(units), dtype=np.int64)
    if not units:
        return out
    sym, lengths = vocabulary.symbols(units)
    seq = np.repeat(np.arange(len(units)), lengths)
    long = lengths > HEAP_LENGTH
    if long.any():
        ends = np.cumsum(lengths)
        for u in np.flatnonzero(long):
            left = merge_one(vocabulary, sym[ends[u] - lengths[u] : ends[u]].tolist())
            out[u] = sum(1 if s >= 0 else -s for s in left)
        keep = ~long[seq]
        sym, seq = sym[keep], seq[keep]

    def pairs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of the pair that begins at each of these places."""
        rank, merged = np.full(len(at), NO_PAIR, dtype=np.int32), np.full(len(at), -1, dtype=np.int32)
        ok = at + 1 < len(sym)
        ok[ok] = seq[at[ok]] == seq[at[ok] + 1]
        rank[ok], merged[ok] = vocabulary.find(sym[at[ok]], sym[at[ok] + 1])
        return rank, merged

    rank, merged = pairs(np.arange(len(sym)))
    while len(sym):
        head = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
        best = np.minimum.reduceat(rank, head)
        size = np.diff(np.r_[head, len(sym)])
        best = np.repeat(best, size)
        if (done := best == NO_PAIR).any():
            np.add.at(out, seq[done], np.where(sym[done] >= 0, 1, -sym[done]))
            go = ~done
            sym, seq, rank, merged, best = sym[go], seq[go], rank[go], merged[go], best[go]
            continue
        hit = np.flatnonzero(rank == best)
        first = np.r_[True, seq[hit][1:] != seq[hit][:-1]]
        run = np.r_[True, hit[1:] != hit[:-1] + 1] | first
        odd = (hit - hit[run][np.cumsum(run) - 1]) % 2 == 1
        hit = hit[first | ~(odd | vocabulary.leftmost[merged[hit]])]
        sym[hit] = merged[hit]
        stay = np.ones(len(sym), dtype=bool)
        stay[hit + 1] = False
        moved = np.cumsum(stay) - 1
        sym, seq, rank, merged = sym[stay], seq[stay], rank[stay], merged[stay]
        at = moved[hit]
        before = at[at > 0] - 1
        changed = np.zeros(len(sym), dtype=bool)
        changed[at] = changed[before] = True
        again = np.flatnonzero(changed)
        rank[again], merged[again] = pairs(again)
    return out


class UnitCounter:
    """Token counts of texts, with the counts of recent units remembered."""

    def __init__(self, path: str):
        self.vocabulary = piece_table(path)
        self.known: dict[str, int] = {}

    def learn(self, units: list[str]) -> None:
        batch: list[str] = []
        chars = 0
        for i, unit in enumerate(units):
            batch.append(unit)
            chars += len(unit)
            if chars >= MERGE_CHARS or i == len(units) - 1:
                self.known.update(zip(batch, merge_counts(self.vocabulary, batch).tolist()))
                batch, chars = [], 0

    def count(self, texts: list[str]) -> list[int]:
        counted = [Counter(units_of(t)) for t in texts]
        if len(self.known) > REMEMBERED_UNITS:
            self.known.clear()
        new = {u for c in counted for u in c if u not in self.known}
        self.learn(list(new))
        known = self.known
        return [sum(map(mul, map(known.__getitem__, c), c.values())) for c in counted]


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, limit: int = 4096) -> DataFrame:
    """Tokens of each whole text under a SentencePiece BPE vocabulary: key, n_bytes, n_tokens, over_limit.

    Null and empty texts have 0 bytes and 0 tokens. Rows are kept one for one, repeated keys and texts too; null keys
    stay null; other columns are left out. An empty table gives an empty table. No shuffle: a task holds a few
    hundred texts and a bounded table of remembered units.
    """
    path = path or default_path("piece_bpe_32k.model")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnitCounter(path)
        for batch in batches:
            texts = as_text(batch.column(1))
            for lo in range(0, len(texts), 256):
                part = texts.slice(lo, 256)
                counts = pa.array(counter.count(part.to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 256), counts], names=["key", "n_tokens"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    sized = rows.select(
        F.struct("key", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")).alias("key"), "text"
    )
    counted = sized.mapInArrow(work, f"key struct<key:{kind},n_bytes:bigint>, n_tokens bigint")
    return counted.select(
        F.col("key.key").alias(key),
        F.col("key.n_bytes").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
