"""Column functions on run-log and accounting text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.dna import _col

# The shapes of the log and accounting lines we must read.
LOG_SUBMITTED = r"\[SLURM\] submitted process (.+?) > jobId: (\d+)"
LOG_COMPLETED = r"Task completed > TaskHandler\[(.+?)\]"
LOG_KEY_VALUE = r"(\w+): ([^;]+)"
LOG_STARTED = r"\bstarted: (\d+|-)"
LOG_EXITED = r"\bexited: ([^;]+)"
USAGE_WALL = r"Job Wall-clock time:\s+(\S+)"
USAGE_CPU_EFF = r"CPU Efficiency:\s+(\S+)"
USAGE_MEM_USED = r"Memory Utilized:\s+(.+)"
USAGE_MEM_EFF = r"Memory Efficiency:\s+(\S+)"
USAGE_MEM_REQUESTED = r"Memory Efficiency:.*of\s+([\d.]+\s*\S+)"
USAGE_CPUS = r"Cores per node:\s+(\d+)"


def extract(text: Column | str, pattern: str, group: int = 1) -> Column:
    """Regex group, trimmed; null when the pattern does not occur."""
    return F.nullif(F.trim(F.regexp_extract(_col(text), pattern, group)), F.lit(""))


def dash_to_null(text: Column | str) -> Column:
    return F.nullif(F.trim(_col(text)), F.lit("-"))


def kv_pairs(block: Column | str) -> Column:
    """'a: 1; b: 2' -> array of (k, v)."""
    block = _col(block)
    return F.zip_with(
        F.regexp_extract_all(block, F.lit(LOG_KEY_VALUE), F.lit(1)),
        F.regexp_extract_all(block, F.lit(LOG_KEY_VALUE), F.lit(2)),
        lambda k, v: F.struct(k.alias("k"), F.trim(v).alias("v")),
    )


def last_value(pairs: Column | str, key: str) -> Column:
    """Value of a key among pairs; of repeated keys the last; null when absent."""
    return F.try_element_at(F.filter(_col(pairs), lambda p: p["k"] == key), F.lit(-1))["v"]


def kv_value(block: Column | str, key: str) -> Column:
    return last_value(kv_pairs(block), key)


def parse_kv_block(block: Column | str) -> Column:
    """'a: 1; b: 2' -> map; of repeated keys the last wins."""
    empty = F.create_map().cast("map<string,string>")

    def put(m, pair):
        others = F.map_filter(m, lambda k, _: k != pair["k"])
        return F.map_concat(others, F.create_map(pair["k"], pair["v"]))

    return F.aggregate(kv_pairs(block), empty, put)


def epoch_ms_to_ts(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms).try_cast("bigint"))


def iso_to_ts(text: Column | str) -> Column:
    """ISO text, trailing Z dropped, read as UTC; null for text that is no timestamp."""
    return F.concat(F.regexp_replace(F.trim(_col(text)), "Z+$", ""), F.lit("+00:00")).try_cast("timestamp")


def round_binary(value: Column | str, decimals: int = 2) -> Column:
    """Round by the exact binary value, ties to even: 2.675 -> 2.67, 0.125 -> 0.12.

    Spark rounds the shortest decimal text of a double instead (2.675 -> 2.68). Here value * scale is
    held without error as product + remainder (Dekker's split), which decides the cases near a tie.
    """
    value = _col(value)
    scale = F.lit(float(10**decimals))
    big = value * F.lit(134217729.0)  # 2**27 + 1
    high = big - (big - value)
    low = value - high
    product = value * scale
    remainder = (high * scale - product) + low * scale
    whole = F.floor(product).cast("double")
    past_half = ((product - whole) - F.lit(0.5)) + remainder
    odd = whole % 2 != 0
    up = (past_half > 0) | ((past_half == 0) & odd)
    return (whole + up.cast("double")) / scale


def duration_min(start: Column | str, end: Column | str) -> Column:
    """Minutes between two timestamps, two decimals; null when negative."""
    minutes = (F.unix_micros(_col(end)) - F.unix_micros(_col(start))) / F.lit(60_000_000.0)
    return F.when(minutes >= 0, round_binary(minutes, 2))


def wall_to_min(wall: Column | str) -> Column:
    """'HH:MM:SS' to minutes; null for any other shape."""
    parts = F.split(_col(wall), ":")
    h, m, s = [F.trim(parts[i]).try_cast("int") for i in range(3)]
    return F.when(F.size(parts) == 3, h * 60 + m + s / F.lit(60.0))


def pct_to_double(pct: Column | str) -> Column:
    return F.regexp_replace(_col(pct), "%+$", "").try_cast("double")


def mem_to_gb(mem: Column | str) -> Column:
    """'512 MB' to gigabytes in steps of 1024; null for other units."""
    shape = r"^([\d.]+)\s*(?i:(GB|MB|KB|TB))"
    value = F.regexp_extract(_col(mem), shape, 1).try_cast("double")
    unit = F.upper(F.regexp_extract(_col(mem), shape, 2))
    return (
        F.when(unit == "TB", value * 1024)
        .when(unit == "GB", value)
        .when(unit == "MB", value / 1024)
        .when(unit == "KB", value / 1024 / 1024)
    )


def base_process_name(process: Column | str) -> Column:
    """Drop one leading 'NAME:' and one trailing '(...)'."""
    no_prefix = F.regexp_replace(_col(process), r"^[A-Z_]+:", "")
    return F.trim(F.regexp_replace(no_prefix, r"\s*\([^)]*\)$", ""))


def sem(values: Column | str) -> Column:
    """Standard error of the mean; null for fewer than two values."""
    values = _col(values)
    return F.stddev_samp(values) / F.sqrt(F.count(values))


def fmt_float(value: Column | str, decimals: int = 2) -> Column:
    value = _col(value)
    return F.when(value.isNull(), "-").otherwise(
        F.format_string(f"%.{decimals}f", round_binary(value, decimals))
    )
