"""WARC archives of pages, and their capture index merged from locally sorted runs by a loser tree."""

from __future__ import annotations

import base64
import bisect
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import materialize, new_path

# Ends each record, as the format asks; the text sink writes it after each row.
RECORD_END = "\r\n\r\n"
# Records in a file. An executor holds one file's compressed bytes at a time.
RECORDS_PER_FILE = 1000
# Index entries merged by one task, about.
RANGE_ENTRIES = 50_000
# Keys looked at per range to place the cuts between ranges.
KEYS_PER_RANGE = 64
_CHUNK = 1 << 16

KEY = ["urlkey", "captured", "page_id", "file", "offset"]


def base32_sha1(text: Column) -> Column:
    """SHA-1 of a text's UTF-8 bytes in upper-case base32: four groups of 40 bits, each eight digits."""
    digits = F.concat(*[F.lpad(F.conv(F.substring(F.sha1(text), 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels reversed and joined by commas, then the path and query. Case of the host is dropped."""
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(?:[wW][wW][wW]\.)?", "")
    host = F.lower(F.regexp_extract(bare, r"^[^/?#:]*", 0))
    rest = F.regexp_replace(bare, r"^[^/?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", F.lit("/")).otherwise(rest))


def _shown(value: Column) -> Column:
    """A header value: control characters, which would end the line, become blanks."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"[\x00-\x1F\x7F]", " ")


def capture_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One WARC record per page, as text: sort columns and `record`.

    Of pages with equal payloads of at least `min_bytes` bytes, the one with the smallest page_id is a response, the
    others revisit it; smaller payloads are all responses. Columns: page_id, url, html.
    """
    rows = pages.select("page_id", _shown(F.col("url")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": base32_sha1(F.col("payload"))})
    # Identities only: no payload is shuffled by its digest, so a payload that a third of the pages share stays spread.
    own = rows.select("page_id", "digest", "bytes")
    first = own.filter(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    revisits = (
        own.join(first.filter("n > 1").drop("n"), "digest").filter("page_id IS NULL OR page_id > first").select("page_id", "digest", "first").distinct()
    )
    revisits = materialize(revisits, "revisits").withColumnRenamed("digest", "d").withColumnRenamed("page_id", "p")
    all_ = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left")
    date = F.date_format(F.timestamp_seconds(F.lit(1577836800) + F.coalesce("page_id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    again = F.col("first").isNotNull()
    id_ = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(again, http).otherwise(F.concat(http, "payload"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), id_,
        F.lit(">\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Date: "), date,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(again, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return all_.select(url_key(F.col("url")).alias("urlkey"), date.alias("captured"), "page_id", F.concat(head, block).alias("record"))


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write compressed archives, each file a run of captures sorted by URL key and time."""
    records = capture_records(pages, min_bytes)
    runs = records.sortWithinPartitions("urlkey", "captured", "page_id").select("record")
    runs.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


class _Inflated:
    """Bytes of a gzip file, unpacked a little at a time."""

    def __init__(self, packed: memoryview):
        self.packed, self.at, self.unpack, self.held, self.offset = packed, 0, zlib.decompressobj(31), bytearray(), 0

    def more(self) -> bool:
        while self.at < len(self.packed) or self.unpack.unconsumed_tail:
            tail = self.unpack.unconsumed_tail
            chunk = tail or self.packed[self.at : self.at + _CHUNK]
            self.at += 0 if tail else len(chunk)
            out = self.unpack.decompress(chunk, 1 << 20)
            if self.unpack.eof and (self.unpack.unused_data or self.at < len(self.packed)):
                self.at -= len(self.unpack.unused_data)
                self.unpack = zlib.decompressobj(31)
            if out:
                self.held += out
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        """Everything before the next mark, which is consumed; None at the end."""
        seen = 0
        while (found := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                if self.held:
                    raise ValueError("the archive ends inside a record")
                return None
        return self.take(found + len(mark))[: -len(mark)]

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        self.offset += n
        return out


def _headers(block: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in block.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def read_records(packed: memoryview) -> Iterator[dict]:
    """Records of one archive: headers, payload and place. A response whose payload doesn't match its digest is an error."""
    stream = _Inflated(packed)
    while True:
        start = stream.offset
        head = stream.until(b"\r\n\r\n")
        if head is None:
            return
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {start}")
        fields = _headers(head)
        block = stream.take(int(fields["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError(f"the record at byte {start} has no end")
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = fields["warc-payload-digest"].partition(":")[2]
        if fields["warc-type"] == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"the payload of the record at byte {start} doesn't match its digest")
        yield {
            "fields": fields,
            "payload": payload,
            "payload_bytes": int(_headers(http)["content-length"]),
            "payload_digest": digest,
            "offset": start,
            "length": stream.offset - start,
        }


_ENTRY = pa.schema(
    [("url", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
)
_ENTRY_SQL = "url string, captured string, page_id bigint, file string, offset bigint, length bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _page(value: str | None) -> int | None:
    found = value[len("<urn:page:") : -1] if value else "null"
    return None if found == "null" else int(found)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of archives, file by file in the order of the records: each file is a sorted run."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows = []
                for r in read_records(memoryview(content.as_buffer())):
                    f = r["fields"]
                    rows.append(
                        (f["warc-target-uri"], f["warc-date"], _page(f["warc-record-id"]), name.as_py(), r["offset"], r["length"],
                         r["payload_bytes"], r["payload_digest"], f["warc-type"], _page(f.get("warc-refers-to")))
                    )
                columns = list(zip(*rows)) or [()] * len(_ENTRY)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ENTRY.types)], schema=_ENTRY)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    entries = files.select("path", "content").mapInArrow(work, _ENTRY_SQL)
    return entries.withColumn("urlkey", url_key(F.col("url")))


class LoserTree:
    """k-way merge of (key, item) pairs: each inner node keeps the loser of its match, so one path of matches follows each output."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, self.k = runs, max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.losers = [-1] * self.k
        self.winner = self._play(1)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x[0], a) < (y[0], b))

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lost
        return won

    def __iter__(self) -> Iterator[tuple]:
        while (out := self.heads[self.winner]) is not None:
            yield out
            won = self.winner
            self.heads[won] = next(self.runs[won], None)
            node = (won + self.k) // 2
            while node >= 1:
                if self._beats(self.losers[node], won):
                    won, self.losers[node] = self.losers[node], won
                node //= 2
            self.winner = won


def _cuts(entries: DataFrame, ranges: int) -> list[tuple]:
    """Keys between ranges, from at most `2 * ranges * KEYS_PER_RANGE` entries with the smallest hashes.

    They only decide how evenly the ranges are filled; entries are merged whole wherever the cuts lie.
    """
    if ranges < 2:
        return []
    wanted = ranges * KEYS_PER_RANGE
    picked = entries.select(*[_sortable(c) for c in KEY], F.xxhash64("file", "offset").alias("h"))
    total = entries.count()
    share = min(1.0, 1.5 * wanted / total)
    picked = picked.filter(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * wanted)
    keys = sorted(tuple(r)[: len(KEY)] for r in picked.collect())
    return [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []


def _sortable(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(-1)).alias(name) if name in ("page_id", "offset") else F.coalesce(F.col(name), F.lit("")).alias(name)


def merge_index(entries: DataFrame) -> DataFrame:
    """Merge locally sorted runs of index entries into capture histories in global order.

    Order: URL key, time, page_id (null first), file, offset. Result: the entries with `range_no` and `place`; rows in
    the order of (range_no, place) are in global order. Tasks cut their runs at shared keys and send each piece to its
    range, which merges the pieces with a loser tree. The key ends with the place of the record, so a URL with a third
    of all captures is cut into many ranges too. An empty table gives an empty index.
    """
    stored = materialize(entries, "captures")
    ranges = -(-stored.count() // RANGE_ENTRIES)
    cuts = _cuts(stored, ranges)
    names = stored.columns
    places = [names.index(c) for c in KEY]
    kind = f"struct<{', '.join(f'{f.name}:{f.dataType.simpleString()}' for f in stored.schema.fields)}>"

    def key_of(row: tuple) -> tuple:
        return tuple((-1 if c in ("page_id", "offset") else "") if row[p] is None else row[p] for c, p in zip(KEY, places))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = None
        for batch in batches:
            entry = pa.struct([(n, t) for n, t in zip(names, batch.schema.types)])
            rows = list(zip(*[c.to_pylist() for c in batch.columns]))
            pieces: list[tuple[int, list[tuple]]] = []
            last = None
            for row in rows:
                k = key_of(row)
                r = bisect.bisect_right(cuts, k)
                if last is None or k < last or pieces[-1][0] != r:
                    pieces.append((r, []))
                pieces[-1][1].append(row)
                last = k
            listed = [[dict(zip(names, row)) for row in piece] for _, piece in pieces]
            out = [pa.array([r for r, _ in pieces], pa.int32()), pa.array(listed, pa.list_(entry))]
            yield pa.RecordBatch.from_arrays(out, names=["range_no", "piece"])

    def merge(group: pa.Table) -> pa.Table:
        r = group.column("range_no")[0].as_py()
        runs = [[tuple(e.values()) for e in piece] for piece in group.column("piece").to_pylist()]
        merged = [row for _, row in LoserTree([iter([(key_of(row), row) for row in run]) for run in runs])]
        entry = group.schema.field("piece").type.value_type
        columns = [pa.array(c, entry.field(i).type) for i, c in enumerate(zip(*merged))]
        order = [pa.array([r] * len(merged), pa.int32()), pa.array(range(len(merged)), pa.int32())]
        return pa.Table.from_arrays([*order, *columns], names=["range_no", "place", *names])

    pieces = stored.mapInArrow(cut, f"range_no int, piece array<{kind}>")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema.fields)
    return pieces.groupBy("range_no").applyInArrow(merge, f"range_no int, place int, {fields}")


def archive_pages(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write pages as archives under `path` (a new folder of the work area if None), read them back, merge their index.

    One row per page with page_id, payload_bytes, payload_digest, record_type, refers_to, and the index columns. Null
    html is an empty payload; a null url is empty; control characters in a url become blanks. Rows with a null page_id
    revisit the smallest page_id of their payload if there is one, else are responses. Repeated rows are all written;
    repeats of the smallest page_id are all responses. Other columns are left out.
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    write_warc(pages, path, min_bytes)
    return merge_index(read_captures(spark, path))
