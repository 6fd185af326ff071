"""Benchmark decontamination: a broadcast set of normalised n-grams, scanned against all windows of the documents.

DataFrame functions only. A window's 64-bit hash is built from the hashes of its halves, so the hashes of all windows
of a document come from a few passes over one array; no window text is made. Each hit is then checked word by word.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import materialize, sized_broadcast

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_array(text: Column) -> Column:
    """Words after lower-casing A-Z: runs of digits, ASCII letters and all characters beyond ASCII. Null has none."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, NO_WORD), "")


def with_window_hashes(rows: DataFrame, words: str, length: int, out: str) -> DataFrame:
    """Adds `out`: a hash for each window of `length` words, in order; empty if there are fewer words.

    Hashes of 1, 2, 4, 8 words are columns of their own, each made once from the one before; the set bits of `length`
    are then put together.
    """

    def beside(left: str, right: str, shift: int) -> Column:
        return F.zip_with(left, F.slice(right, F.lit(shift + 1), F.lit(1 << 30)), lambda a, b: F.xxhash64(a, b))

    rows = rows.withColumn("power1__", F.transform(words, lambda w: F.xxhash64(w)))
    powers = ["power1__"]
    made, covered, size = None, 0, 1
    while size <= length:
        if length & size:
            if made:
                rows = rows.withColumn(f"made{size}__", beside(made, f"power{size}__", covered))
            made, covered = f"made{size}__" if made else f"power{size}__", covered + size
            powers.append(made)
        if 2 * size <= length:
            rows = rows.withColumn(f"power{2 * size}__", beside(f"power{size}__", f"power{size}__", size))
            powers.append(f"power{2 * size}__")
        size *= 2
    rows = rows.withColumn(out, F.slice(made, F.lit(1), F.greatest(F.size(words) - (length - 1), F.lit(0))))
    return rows.drop(*powers)


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = 10) -> DataFrame:
    """Distinct windows of the items: window (words), length, hash, items (distinct ids).

    An item of fewer than `size` words, but not none, is one window of its length. An item without words has none.
    """
    rows = benchmark.select(F.col(item).alias("item"), words_array(F.col(text)).alias("words")).filter(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    windows = rows.select("item", length.alias("length"), F.explode(F.transform(starts, lambda i: F.slice("words", i, length))).alias("window"))
    grouped = windows.groupBy("length", "window").agg(F.collect_set("item").alias("items"))
    by_length = [with_window_hashes(grouped.filter(F.col("length") == n), "window", n, "hashes") for n in range(1, size + 1)]
    return functools.reduce(DataFrame.unionByName, by_length).withColumn("hash", F.col("hashes")[0]).drop("hashes")


def find_hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = 10) -> DataFrame:
    """All rows of `docs`, with its columns, and: `words__` (words), `hits__` (array of pos from 0, length, items).

    Repeated rows stay; rows with one key and different texts are told apart by the hash of the text.
    """
    windows = materialize(benchmark_windows(benchmark, item, item_text, size), "windows")
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())
    lookup = sized_broadcast(windows.groupBy("hash", "length").agg(F.collect_list(F.struct("window", "items")).alias("found")))
    content = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = docs.select(F.col(key).alias("k"), content.alias("c"), words_array(F.col(text)).alias("words"))
    hits = None
    for n in lengths:
        # The outer form: for the inner one the planner adds a filter on the array, below which it would make all hashes again.
        places = with_window_hashes(rows, "words", n, "hashes").select("k", "c", F.posexplode_outer("hashes").alias("pos", "hash"))
        own = places.join(lookup.filter(F.col("length") == n), "hash")
        hits = own if hits is None else hits.unionByName(own)
    if hits is None:
        return docs.withColumns({"words__": words_array(F.col(text)), "hits__": F.array().cast("array<struct<pos:int,length:int,items:array<string>>>")})
    # A hash may belong to two windows; which of them is there is decided on the words themselves.
    grouped = hits.select("k", "c", "pos", "length", F.inline("found")).groupBy("k", "c").agg(F.collect_set(F.struct("pos", "length", "window", "items")).alias("found__"))
    stored = materialize(grouped, "hits").withColumnsRenamed({"k": "k__", "c": "c__"})
    joined = docs.withColumn("content__", content).join(stored, F.col(key).eqNullSafe(F.col("k__")) & (F.col("content__") == F.col("c__")), "left")
    joined = joined.withColumn("words__", words_array(F.col(text)))
    true = F.filter(F.coalesce("found__", F.array()), lambda h: F.slice("words__", h["pos"] + 1, h["length"]) == h["window"])
    ids = F.transform(true, lambda h: F.struct(h["pos"].alias("pos"), h["length"].alias("length"), F.transform(h["items"], lambda i: i.cast("string")).alias("items")))
    return joined.withColumn("hits__", ids).drop("k__", "c__", "content__", "found__")


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, items_sha256, contaminated, and the hit windows.

    A word inside any occurrence of a window is hit. `n_items` counts items with an occurring window; `items_sha256` is
    the SHA-256 of their ids, sorted as strings and joined by commas (of the empty string if there are none). Null and
    empty texts have no words; null item ids count as no item, though their windows hit. Rows are kept one for one. An
    empty benchmark contaminates nothing.
    """
    found = find_hits(docs, benchmark, key, text, **names)
    hit = F.array_distinct(F.flatten(F.transform("hits__", lambda h: F.sequence(h["pos"], h["pos"] + h["length"] - 1))))
    ids = F.array_sort(F.array_distinct(F.filter(F.flatten(F.transform("hits__", lambda h: h["items"])), lambda i: i.isNotNull())))
    out = found.select(F.col(key), F.size("words__").cast("long").alias("n_words"), F.size(hit).cast("long").alias("n_hit"), ids.alias("items"), F.col("hits__").alias("hits"))
    return out.select(
        key, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "hits",
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The documents without any hit, with all their columns unchanged."""
    found = find_hits(docs, benchmark, key, text, **names)
    return found.filter(F.size("hits__") == 0).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """All documents, hit words cut from the text together with the characters up to the next word."""
    found = find_hits(docs, benchmark, key, text, **names)
    hit = F.array_distinct(F.flatten(F.transform("hits__", lambda h: F.sequence(h["pos"], h["pos"] + h["length"] - 1))))
    # The gap before the first word, then each word with the gap after it: word i of the text is part i of these.
    lead = F.regexp_extract(F.col(text), r"^[\x00-\x2F\x3A-\x60\x7B-\x7F]*", 0)
    parts = F.regexp_extract_all(F.col(text), F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"), F.lit(0))
    kept = F.filter(parts, lambda part, i: ~F.array_contains(hit, i))
    cut = F.when(F.size("hits__") == 0, F.col(text)).otherwise(F.concat(lead, F.array_join(kept, "")))
    return found.withColumn(text, cut).select(*docs.columns)
