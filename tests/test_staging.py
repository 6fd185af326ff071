"""What queries store of the reads before they decode them."""

import pyarrow as pa
from pyspark.sql import types as T

from tagloom.operators import indel_search
from tagloom.plans import query_set


def test_decoding_stores_only_what_it_reads(spark, sf):
    reads, _, _ = query_set.decode_inputs(spark, sf)
    assert reads.columns == ["selection_id", "read_id", "seq"]
    whole = query_set.Q.staged_reads(spark, sf)
    assert {"l_orderkey", "qual"} < set(whole.columns)
    assert reads.exceptAll(whole.select(*reads.columns)).isEmpty() and reads.count() == whole.count()


def test_a_block_of_tags_adds_to_what_earlier_blocks_found(spark):
    """Answers are filled in by arrays: nearer tags replace, as near ones make ambiguous and move to the earlier end."""
    answer = {"strand": pa.string(), "library_id": pa.string(), "lib_pos": pa.int32(), "lib_mismatches": pa.int32(), "lib_end": pa.int32(), "lib_surplus": pa.int32()}
    rows = [
        ("TTACGTACGGCATT", "+", None, None, None, None, None, True),  # found
        ("TTACGTACGGCATT", "+", "L2", 9, 0, 14, 0, True),  # as near, ends later
        ("TTACGTACGGCATT", "+", "L2", 0, 0, 8, 0, True),  # as near, ends earlier
        ("TTACGTACGGCATT", "-", "L2", 3, 1, 9, 0, True),  # nearer
        ("TTACGTACGGCATT", "+", "L2", 3, 2, 9, 0, False),  # not asked
        (None, "+", None, None, None, None, None, True),
    ]
    names = ["seq", *answer, "open__"]
    columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), [pa.string(), *answer.values(), pa.bool_()])]

    class Called:
        schema = T._parse_datatype_string("seq string, strand string, library_id string, lib_pos int, lib_mismatches int, lib_end int, lib_surplus int, open__ boolean")

        def mapInArrow(self, kernel, schema):
            return [r for b in kernel([pa.RecordBatch.from_arrays(columns, names=names)]) for r in b.to_pylist()]

    got = [tuple(r[c] for c in answer) for r in indel_search._search_block(Called(), [("L1", "ACGTACGGCA")], ["+", "-"], 2)]
    here = ("+", "L1", 2, 0, 12, 0)
    assert got == [here, ("+", "*", 2, 0, 12, 0), ("+", "*", 0, 0, 8, 0), here, ("+", "L2", 3, 2, 9, 0), ("+", None, None, None, None, None)]
