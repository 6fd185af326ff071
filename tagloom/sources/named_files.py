"""Write lines to files whose names are data, one file per name."""

from __future__ import annotations

import sys
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COPY_BYTES = 8 << 20


def _fs(path: str):
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def write_named_lines(lines: DataFrame, folder: str, name: str, text: str, order: list[Column | str]) -> int:
    """Write `text` lines of equal `name` to folder/name in `order`; returns the number of files.

    Lines are dealt by ranges of (name, order), so a file of any size is sorted and written in pieces by many tasks; one
    task then lays the pieces of a file end to end, byte blocks at a time. Rows are streamed: nothing but the current batch
    is held. A file appears under its name only when complete, so retried and speculative tasks are harmless.
    """

    def write(batches):
        current, sink, temp, at, fs, root = None, None, None, 0, None, None

        def close():
            sink.close()
            return pa.RecordBatch.from_pydict({"file": [current], "piece": [temp], "part": pa.array([part], pa.int32()), "at": pa.array([at], pa.int32())})

        for batch in batches:
            part = batch.column(2)[0].as_py()
            for file, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if file != current:
                    if sink is not None:
                        yield close()
                        at += 1
                    fs, root = _fs(folder)
                    fs.create_dir(f"{root}/{file}".rsplit("/", 1)[0], recursive=True)
                    current, temp = file, f".{uuid.uuid4().hex}"
                    sink = fs.open_output_stream(f"{root}/{temp}")
                sink.write(line.encode() + b"\n")
        if sink is not None:
            yield close()

    def join(batches):
        fs, root = _fs(folder)
        current, pieces = None, []

        def finish():
            # An earlier attempt at this task may have come to its end with this file: its pieces are gone then.
            infos = fs.get_file_info([f"{root}/{p}" for p in pieces])
            if all(i.type == pafs.FileType.File for i in infos):
                whole = pieces[0]
                if len(pieces) > 1:
                    whole = f".{uuid.uuid4().hex}"
                    with fs.open_output_stream(f"{root}/{whole}") as sink:
                        for piece in pieces:
                            with fs.open_input_stream(f"{root}/{piece}") as source:
                                while block := source.read(COPY_BYTES):
                                    sink.write(block)
                fs.move(f"{root}/{whole}", f"{root}/{current}")
                for piece in pieces[1:] + pieces[:1] * (len(pieces) > 1):
                    fs.delete_file(f"{root}/{piece}")
            elif fs.get_file_info(f"{root}/{current}").type != pafs.FileType.File:
                raise FileNotFoundError(f"pieces of {root}/{current}")
            else:
                for i in infos:
                    if i.type == pafs.FileType.File:
                        fs.delete_file(i.path)
            return pa.RecordBatch.from_pydict({"file": [current]})

        for batch in batches:
            for file, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if file != current:
                    if pieces:
                        yield finish()
                    current, pieces = file, []
                pieces.append(piece)
        if pieces:
            yield finish()

    arranged = lines.repartitionByRange(name, *order).sortWithinPartitions(name, *order).select(name, text, F.spark_partition_id())
    pieces = materialize(arranged.mapInArrow(write, "file string, piece string, part int, at int"), "pieces")
    placed = pieces.repartition("file").sortWithinPartitions("file", "part", "at").select("file", "piece")
    return placed.mapInArrow(join, "file string").agg(F.count("file")).first()[0]
