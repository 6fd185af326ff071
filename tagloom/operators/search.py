"""Library search over all positions of a read, for reads without a fixed layout start.

No column expression walks every window of a string against a tag list without one row per
window, so this is an Arrow kernel: each batch is compared as byte matrices.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship this module's functions inside the task, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COMPLEMENT = bytes.maketrans(b"ACGTNacgtn", b"TGCANtgcan")
AMBIGUOUS_LIBRARY = "*"
NOT_FOUND = 1 << 40


def _matrix(seqs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Zero-padded byte matrix and lengths."""
    lengths = np.fromiter((len(s) for s in seqs), dtype=np.int64, count=len(seqs))
    width = int(lengths.max(initial=0))
    flat = b"".join(s.ljust(width, b"\0") for s in seqs)
    return np.frombuffer(flat, dtype=np.uint8).reshape(len(seqs), width), lengths


def best_positions(seqs: list[bytes], tag: bytes, tolerance: int, min_overlap: int):
    """Per read: packed (mismatches, overlap, position) of the best placement; NOT_FOUND if none.

    Tags may stick out of either read end by all but `min_overlap` bases.
    """
    bases, lengths = _matrix(seqs)
    n, width = bases.shape
    k = len(tag)
    need = min(min_overlap, k)
    pad = k - need
    wide = np.zeros((n, width + 2 * pad), dtype=np.uint8)
    wide[:, pad : pad + width] = bases
    places = width + 2 * pad - k + 1
    if places <= 0:
        return np.full(n, NOT_FOUND, dtype=np.int64)
    same = np.zeros((n, places), dtype=np.int16)
    for j, base in enumerate(tag):
        same += wide[:, j : j + places] == base
    start = np.arange(places) - pad
    overlap = np.minimum(start + k, lengths[:, None]) - np.maximum(start, 0)
    mismatches = overlap - same
    good = (overlap >= need) & (mismatches <= tolerance)
    packed = (mismatches.astype(np.int64) << 30) | ((1023 - overlap) << 20) | (start + pad)
    return np.where(good, packed, NOT_FOUND).min(axis=1)


def search_batch(seqs: list[bytes], tags: list[tuple[str, bytes]], tolerance: int, min_overlap: int):
    """Best library per read: arrays of mismatches (-1: none), library, position."""
    best = np.full(len(seqs), NOT_FOUND, dtype=np.int64)
    library = np.full(len(seqs), None, dtype=object)
    pad = np.zeros(len(seqs), dtype=np.int64)
    for name, tag in tags:
        packed = best_positions(seqs, tag, tolerance, min_overlap)
        tie = (packed < NOT_FOUND) & (packed >> 20 == best >> 20)
        better = (packed >> 20 < best >> 20) | (tie & (packed < best))
        library[better & ~tie] = name
        library[tie & (library != name)] = AMBIGUOUS_LIBRARY
        best = np.where(better, packed, best)
        pad[better] = len(tag) - min(min_overlap, len(tag))
    found = best < NOT_FOUND
    mismatches = np.where(found, best >> 30, -1)
    position = np.where(found, (best & ((1 << 20) - 1)) - pad, 0)
    return mismatches, library, position


def search_library(
    reads: DataFrame,
    libraries: DataFrame,
    strands: list[str],
    tolerance: int = 2,
    min_overlap: int = 8,
    max_libraries: int = 100_000,
) -> DataFrame:
    """Library call anywhere in the read; same output columns as the anchored call."""
    rows = (
        libraries.filter(F.col("tag").isNotNull() & (F.length("tag") > 0))
        .select("library_id", "tag")
        .limit(max_libraries + 1)
        .collect()
    )
    if len(rows) > max_libraries:
        raise ValueError(f"more than {max_libraries} library tags")
    tags = sorted((r.library_id, r.tag.encode()) for r in rows)
    kept = reads.schema.fields
    schema = T.StructType(
        kept
        + [
            T.StructField("strand", T.StringType()),
            T.StructField("library_id", T.StringType()),
            T.StructField("lib_pos", T.IntegerType()),
            T.StructField("lib_mismatches", T.IntegerType()),
        ]
    )
    names = [f.name for f in kept]

    def kernel(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            forward = [(s or "").encode() for s in batch.column("seq").to_pylist()]
            sides = {"+": forward, "-": [s[::-1].translate(COMPLEMENT) for s in forward]}
            calls = {s: search_batch(sides[s], tags, tolerance, min_overlap) for s in strands}
            strand = np.full(len(forward), strands[0], dtype=object)
            mismatches, library, position = calls[strands[0]]
            for other in strands[1:]:
                m, lib, pos = calls[other]
                take = (m >= 0) & ((mismatches < 0) | (m < mismatches))
                strand[take] = other
                mismatches = np.where(take, m, mismatches)
                position = np.where(take, pos, position)
                library[take] = lib[take]
            none = mismatches < 0
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    pa.array(strand, pa.string()),
                    pa.array(library, pa.string()),
                    pa.array(position, pa.int32(), mask=none),
                    pa.array(mismatches, pa.int32(), mask=none),
                ],
                names=[*names, "strand", "library_id", "lib_pos", "lib_mismatches"],
            )

    return reads.mapInArrow(kernel, schema)
