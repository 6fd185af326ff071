"""Column functions on identifiers, file names and packed keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.dna import _col


def bb_array(bb_ids: Column | str) -> Column:
    return F.split(_col(bb_ids), ",").cast("array<int>")


def bb_string(bb: Column | str) -> Column:
    return F.array_join(_col(bb).cast("array<string>"), ",")


def bb_letter(idx: Column | str) -> Column:
    return F.char(_col(idx) + 65)


def bb_set_name(library_id: Column | str, idx: Column | str) -> Column:
    return F.concat(_col(library_id), F.lit("_BB"), bb_letter(idx))


def file_name(path: Column | str) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def file_stem(path: Column | str) -> Column:
    """File name without its last extension; a leading dot does not start an extension."""
    return F.regexp_replace(file_name(path), r"(?<=[^.])\.[^.]*$", "")


def library_id_from_path(path: Column | str) -> Column:
    return F.element_at(F.split(file_stem(path), "_"), -1)


def parse_error_correction(text: Column | str) -> Column:
    """'levenshtein_dist:1,asymmetrical' -> struct(method, distance, flag)."""
    text = _col(text)
    return F.struct(
        F.nullif(F.regexp_extract(text, r"^\s*(\w+)\s*:", 1), F.lit("")).alias("method"),
        F.regexp_extract(text, r":\s*(\d+)", 1).try_cast("int").alias("distance"),
        F.nullif(F.trim(F.regexp_extract(text, r",(.*)$", 1)), F.lit("")).alias("flag"),
    )


def output_prefix(prefix: Column | str, selection_id: Column | str) -> Column:
    """The prefix of output files: the given one, else the selection id."""
    return F.coalesce(F.nullif(F.trim(_col(prefix)), F.lit("")), _col(selection_id))
