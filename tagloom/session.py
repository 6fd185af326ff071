"""Session settings, shared work folder, size-checked joins."""

from __future__ import annotations

import contextlib
import itertools
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup side is broadcast only while its counted rows stay below this.
BROADCAST_ROWS = 2_000_000
# Replication of a lookup side that is too large to broadcast; spreads hot keys.
LOOKUP_SALTS = 32
_lookup_number = itertools.count()
# Work folders of local sessions that name none, by application.
_own_folders: dict[str, str] = {}
# Whether Spark deletes the shuffle files of a query that ended, instead of when the driver collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Paths of the tables stored on the way to another one; see `stored_alone`.
_on_the_way: ContextVar[list[str] | None] = ContextVar("on_the_way", default=None)


def local_session(cpus: str = "8", partitions: str | None = None, **conf: str) -> SparkSession:
    """A session for tests and the bench. On a cluster, pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tagloom")
        .config("spark.sql.shuffle.partitions", partitions or cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir, one sub-folder per application."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        # The setting is fixed once a session runs, so the folder is remembered here.
        app = spark.sparkContext.applicationId
        if app not in _own_folders:
            _own_folders[app] = tempfile.mkdtemp(prefix="tagloom-")
        base = _own_folders[app]
    return f"{base.rstrip('/')}/tagloom-{spark.sparkContext.applicationId}"


def clear_work(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application. Call when its results are written."""
    delete_path(spark, work_dir(spark))


def delete_path(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    Enough where workers see the driver's disk; elsewhere the package is installed or shipped as usual.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def new_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table once to the shared work folder and read it back.

    Cuts lineage, survives executor loss, and gives the planner true sizes.
    """
    path = new_path(df.sparkSession, label)
    if (passing := _on_the_way.get()) is not None:
        passing.append(path)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written in here go when it is written; nothing reads them again."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def stored_alone(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """The table that `make` gives, stored; the tables that were stored on the way to it are deleted."""
    passing: list[str] = []
    outer = _on_the_way.set(passing)
    try:
        out = materialize(make(), label)
        kept = passing.pop()
    finally:
        _on_the_way.reset(outer)
        for path in passing:
            delete_path(spark, path)
    if (around := _on_the_way.get()) is not None:
        around.append(kept)
    return out


def is_small(stored: DataFrame, limit: int | None = None) -> bool:
    """True when a stored table has at most `limit` rows; a count of Parquet footers."""
    return stored.count() <= (BROADCAST_ROWS if limit is None else limit)


def sized_broadcast(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Store a lookup side, then broadcast it if its counted size allows, else leave it to shuffle.

    Storing first means the size check does not run the side's plan a second time.
    """
    stored = materialize(df, "side")
    return F.broadcast(stored) if is_small(stored, limit) else stored


def end_span(df: DataFrame) -> DataFrame:
    """End a whole-stage code span here, without a shuffle.

    A row counter is not fused with its neighbours. One span over many lookups compiles to a method
    past 8000 bytes, which the JVM leaves interpreted (measured: 4x slower).
    """
    return df.observe(f"rows-{uuid.uuid4().hex[:12]}", F.count(F.lit(1)).alias("rows"))


def lookup(
    left: DataFrame,
    table: DataFrame,
    keys: dict[str, Column],
    values: dict[str, str],
    broadcast: bool,
    spread: Column | None = None,
) -> DataFrame:
    """Left join against a table that is unique on its keys.

    `keys` maps table columns to expressions over `left`, `values` maps table columns to output
    names. A key expression may be null: the row then finds nothing. With `broadcast` false the
    rows are shuffled on (keys, salt): `spread` salts hot keys and gives rows with null keys a
    private key, so neither gathers in one task.
    """
    key_names = list(keys)
    # Key columns stay behind under unused names; the planner drops what no later step reads.
    number = next(_lookup_number)
    names = {k: f"__k{number}_{i}" for i, k in enumerate(key_names)}
    right = table.select(
        *[F.col(k).alias(names[k]) for k in key_names],
        *[F.col(v).alias(out) for v, out in values.items()],
    )
    if broadcast:
        condition = [F.col(names[k]) == expr for k, expr in keys.items()]
        return left.join(F.broadcast(right), condition, "left")
    last = key_names[-1]
    salted = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_SALTS - 1))))
    probes = {f"__p{i}": expr for i, expr in enumerate(keys.values())}
    probe_last = f"__p{len(keys) - 1}"
    own_key = F.concat(F.lit("~"), spread.cast("string"))
    probed = left.withColumns(
        {
            **probes,
            probe_last: F.coalesce(keys[last], own_key),
            "__ps": F.pmod(F.xxhash64(spread), F.lit(LOOKUP_SALTS)).cast("int"),
        }
    )
    condition = [F.col(f"__p{i}") == F.col(names[k]) for i, k in enumerate(key_names)]
    condition.append(F.col("__ps") == F.col("__salt"))
    joined = probed.join(salted.hint("merge"), condition, "left")
    return joined.drop(*names.values(), *probes, "__ps", "__salt")
