"""Outputs in the formats downstream tools read."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.ids import output_prefix
from tagloom.functions.text import fmt_float
from tagloom.schemas import COLLECTED
from tagloom.session import freed_shuffles
from tagloom.sources.named_files import write_named_lines


def _mode(df: DataFrame):
    return df.write.mode("overwrite")


def fastq_text(reads: DataFrame) -> DataFrame:
    return reads.select(
        F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), "qual").alias("value")
    )


def write_fastq(reads: DataFrame, path: str, compression: str | None = None) -> None:
    writer = _mode(fastq_text(reads))
    if compression:
        writer = writer.option("compression", compression)
    with freed_shuffles(reads.sparkSession):
        writer.text(path)


def write_decoded(decoded: DataFrame, path: str) -> None:
    _mode(decoded).option("sep", "\t").csv(path, header=True)


def collected_to_json(collected: DataFrame) -> DataFrame:
    """One JSON text per compound, keys in the order library_id, bb_ids, umi_counts."""
    return collected.select(
        F.to_json(F.struct("library_id", "bb_ids", "umi_counts")).alias("value")
    )


def collected_from_json(texts: DataFrame, column: str = "value") -> DataFrame:
    """Collected compounds from their JSON texts, one compound a text; a text that is no such object gives nulls."""
    return texts.select(F.from_json(column, COLLECTED).alias("c")).select("c.*")


def write_collected(collected: DataFrame, path: str) -> None:
    """NDJSON, one folder per selection when there is a selection column."""
    body = ["library_id", "bb_ids", "umi_counts"]
    if "selection_id" in collected.columns:
        _mode(collected.select("selection_id", *body)).partitionBy("selection_id").json(path)
    else:
        _mode(collected.select(*body)).json(path)


def write_counts(counts: DataFrame, path: str) -> None:
    _mode(counts).partitionBy("selection_id").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    _mode(df).parquet(path)


def with_prefix(df: DataFrame, selections: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """Add the output-file prefix of each selection."""
    if selections is None:
        return df.withColumn("file_prefix", output_prefix(F.lit(prefix), "selection_id"))
    own = selections.select("selection_id", output_prefix("prefix", "selection_id").alias("file_prefix"))
    return df.join(own, "selection_id", "left").withColumn(
        "file_prefix", F.coalesce("file_prefix", "selection_id")
    )


def stats_json(stats: DataFrame) -> DataFrame:
    """One JSON object per selection: {library: {outcome: reads}}."""
    per_library = stats.groupBy("selection_id", "library_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("outcome", "n")))).alias("m")
    )
    return per_library.groupBy("selection_id").agg(
        F.to_json(
            F.map_from_entries(
                F.array_sort(F.collect_list(F.struct(F.coalesce("library_id", F.lit("")), "m")),
                             lambda a, b: F.when(a["col1"] < b["col1"], -1).when(a["col1"] > b["col1"], 1).otherwise(0))
            )
        ).alias("value")
    )


def rows_json(df: DataFrame) -> DataFrame:
    """One JSON object per selection holding its rows."""
    body = [c for c in df.columns if c != "selection_id"]
    return df.groupBy("selection_id").agg(
        F.to_json(F.array_sort(F.collect_list(F.struct(*body)))).alias("value")
    )


def write_stats_json(
    texts: DataFrame, folder: str, suffix: str, selections: DataFrame | None = None, prefix: str = ""
) -> int:
    """<prefix>_<suffix>.json per selection from (selection_id, value)."""
    named = with_prefix(texts, selections, prefix).select(
        F.concat("file_prefix", F.lit(f"_{suffix}.json")).alias("file"), "value"
    )
    return write_named_lines(named, folder, "file", "value", ["value"])


def csv_cell(value: Column) -> Column:
    """A CSV cell: null is empty; commas, quotes and line ends are put in quotes."""
    text = F.coalesce(value, F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[,"\r\n]'), quoted).otherwise(text)


def write_library_defs(
    sections: DataFrame, sets: DataFrame, building_blocks: DataFrame, folder: str
) -> tuple[int, int]:
    """libraries/<id>.json and building_blocks/<set>.csv; returns the numbers of files."""
    keep = F.filter(
        F.array(
            *[
                F.when(
                    F.col(c).isNotNull(),
                    F.concat(F.lit(f'"{c}": '), F.to_json(F.array(F.col(c)))),
                )
                for c in ("tag", "overhang", "error_correction")
            ]
        ),
        lambda x: x.isNotNull(),
    )
    # to_json of one-element arrays quotes a text; strip the brackets.
    fields = F.transform(keep, lambda x: F.regexp_replace(x, r'^("[a-z_]+": )\[(.*)\]$', "$1$2"))
    body = F.concat(F.lit('"'), "section", F.lit('": {'), F.array_join(fields, ", "), F.lit("}"))
    schema = sections.groupBy("library_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("ord", body.alias("t")))), lambda s: s["t"]),
            ", ",
        ).alias("schema")
    )
    bb_sets = sets.groupBy("library_id").agg(
        F.to_json(F.array_sort(F.collect_list(F.struct("cycle", "bb_set_name")))).alias("sets"),
        F.first("dna_barcode_on").alias("on"),
    )
    texts = schema.join(bb_sets, "library_id").select(
        F.concat(F.lit("libraries/"), "library_id", F.lit(".json")).alias("file"),
        F.concat(
            F.lit('{"barcode_schema": {'), "schema", F.lit('}, "bb_sets": '), "sets",
            F.lit(', "dna_barcode_on": "'), "on", F.lit('"}'),
        ).alias("value"),
    )
    n_libraries = write_named_lines(texts, folder, "file", "value", ["value"])
    place = F.concat(F.lit("building_blocks/"), "bb_set_name", F.lit(".csv"))
    id_text = F.col("id_text" if "id_text" in building_blocks.columns else "id").cast("string")
    rows = building_blocks.select(
        place.alias("file"),
        F.col("line_no").alias("at") if "line_no" in building_blocks.columns else F.col("id").alias("at"),
        F.concat(csv_cell(id_text), F.lit(","), csv_cell(F.col("tag"))).alias("value"),
    )
    heads = rows.select("file").distinct().select("file", F.lit(-1).alias("at"), F.lit("id,tag").alias("value"))
    n_sets = write_named_lines(heads.unionByName(rows), folder, "file", "value", ["at"])
    return n_libraries, n_sets


def summary_path(path: str) -> str:
    """jobs.csv -> jobs_summary.csv; without an extension, .csv is added."""
    stem, dot, ext = path.rpartition(".")
    return f"{stem}_summary.{ext}" if dot and "/" not in ext else f"{path}_summary.csv"


def job_cells(jobs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Job records as text cells, '-' for what is missing; columns of `keep` stay as they are."""
    utc = lambda c: F.convert_timezone(None, F.lit("UTC"), F.col(c).cast("timestamp_ntz"))
    stamp = lambda c: F.coalesce(F.date_format(utc(c), "yyyy-MM-dd HH:mm:ss"), F.lit("-"))
    dash = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    usage = [c for c in ("wall_clock", "cpu_eff", "mem_used", "mem_eff") if c in jobs.columns]
    return jobs.select(
        dash("job_id").alias("job_id"),
        dash("process").alias("process"),
        F.coalesce("status", F.lit("SUBMITTED")).alias("status"),
        dash("exit_code").alias("exit"),
        stamp("started").alias("started"),
        stamp("exited").alias("exited"),
        dash("duration_min").alias("dur(min)"),
        *[dash(c).alias(c) for c in usage],
        *keep,
    )


def summary_cells(summary: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Summary as text cells; memory with three decimals, other numbers with two. Shares are headed by a percent sign."""
    out = []
    for name, kind in summary.dtypes:
        head = name.removesuffix("pct") + "%" if name.endswith("_pct") else name
        if name in keep:
            out.append(F.col(name))
        elif kind == "double":
            out.append(fmt_float(name, 3 if "gb" in name else 2).alias(head))
        else:
            out.append(F.coalesce(F.col(name).cast("string"), F.lit("-")).alias(head))
    return summary.select(*out)


def write_job_tables(jobs: DataFrame, summary: DataFrame, path: str) -> None:
    """Job table and summary as one CSV file each, with header, at `path` and its summary name."""
    order = [c for c in ("run_id", "first_line") if c in jobs.columns] or ["job_id"]
    keys = F.struct(*[F.col(c) for c in order])
    _write_csv(jobs.withColumn("key__", keys), job_cells, path)
    _write_csv(summary.withColumn("key__", F.struct("process")), summary_cells, summary_path(path))


def _write_csv(rows: DataFrame, cells, path: str) -> None:
    """One CSV file of text cells in the order of `key__`; its rows are streamed through the task that writes it."""
    folder, _, name = path.rpartition("/")
    text = cells(rows.drop("key__"))
    columns = text.columns
    line = F.concat_ws(",", *[csv_cell(F.col(f"c.`{c}`")) for c in columns])
    body = cells(rows, keep=("key__",)).select(F.lit(name).alias("file"), F.lit(1).alias("part"), "key__", F.struct(*[F.col(f"`{c}`") for c in columns]).alias("c"))
    body = body.select("file", "part", "key__", line.alias("value"))
    head = rows.sparkSession.range(1).select(
        F.lit(name).alias("file"), F.lit(0).alias("part"), F.lit(None).cast(body.schema["key__"].dataType).alias("key__"), F.lit(",".join(columns)).alias("value")
    )
    write_named_lines(head.unionByName(body), folder or ".", "file", "value", ["part", "key__"])


