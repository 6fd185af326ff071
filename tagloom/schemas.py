"""Fixed schemas of the tables that travel between operators."""

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(**fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


READS = _struct(selection_id=_S, lane=_I, mate=_I, read_id=_S, seq=_S, qual=_S)

DECODE_SETTINGS = _struct(
    library_error_tolerance=_I,
    min_library_overlap=_I,
    revcomp=_S,
    demultiplexer_algorithm=_S,
    demultiplexer_mode=_S,
    realign=_S,
    wiggle=_S,
    library_indels=_S,
    section_indels=_S,
)

SELECTIONS = T.StructType(
    [
        T.StructField("selection_id", _S),
        T.StructField("target_id", _S),
        T.StructField("selection_condition", _S),
        T.StructField("date_ran", T.DateType()),
        T.StructField("additional_info", _S),
        T.StructField("sequence_files", T.ArrayType(_S)),
        T.StructField("libraries", T.ArrayType(_S)),
        T.StructField("decode_settings", DECODE_SETTINGS),
        T.StructField("prefix", _S),
    ]
)

LIBRARY_SECTIONS = T.StructType(
    [
        T.StructField("library_id", _S),
        T.StructField("ord", _I),
        T.StructField("section", _S),
        T.StructField("kind", _S),
        T.StructField("tag", _S),
        T.StructField("overhang", _S),
        T.StructField("error_correction", _S),
        T.StructField("start", _I),
        T.StructField("len", _I),
    ]
)

BUILDING_BLOCKS = _struct(library_id=_S, cycle=_I, bb_set_name=_S, id=_I, tag=_S)

DECODED = _struct(
    selection_id=_S,
    read_id=_S,
    strand=_S,
    library_id=_S,
    bb_ids=_S,
    umi=_S,
    lib_mismatches=_I,
    outcome=_S,
)

COLLECTED = T.StructType(
    [
        T.StructField("library_id", _S),
        T.StructField("bb_ids", _S),
        T.StructField("umi_counts", T.ArrayType(_struct(k=_S, c=_L))),
    ]
)

COUNTS = _struct(
    selection_id=_S, library_id=_S, bb_ids=_S, count=_L, raw_count=_L, dedup_count=_L
)

DECODE_STATS = _struct(selection_id=_S, library_id=_S, outcome=_S, n=_L)

JOB_USAGE = _struct(
    job_id=_S,
    wall_clock=_S,
    cpu_eff=_S,
    mem_used=_S,
    mem_eff=_S,
    mem_requested=_S,
    alloc_cpus=_S,
)

REQUESTED_RESOURCES = _struct(process=_S, cpus=_S, memory=_S, time=_S)

COMPOUND = ["selection_id", "library_id", "bb_ids"]
