"""Secret scans: fixed patterns, and tokens that pass a battery of randomness tests. DataFrame functions only.

A match's place comes from the gaps between matches: `split` gives the text before each match, so running sums of
lengths give starts and ends, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.session import materialize

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Runs that are dropped when too short may as well be asked for at their least length: a run is never cut.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
# Candidates of the randomness tests: the longest runs that one encoding can hold, so that in a token with + or / as well as
# _ or - each such part is tested. `=` parts names from values; at the end of a run it is padding and counts as part of it.
LEAST_TOKEN = 20
_PADDING = "(?:={1,6}(?![A-Za-z0-9+/_=-]))?+"
_PLAIN = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9]{14,}+(?![+/_-])"
_URL = "(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]{14})[A-Za-z0-9]*+[_-][A-Za-z0-9_-]*+"
_BASE64 = "(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]{14})[A-Za-z0-9]*+[+/][A-Za-z0-9+/]*+"
# Parts of the two alphabets can overlap, so they are looked for one after the other.
TOKEN = f"(?:{_PLAIN}|{_URL}){_PADDING}"
TOKEN_64 = f"{_BASE64}{_PADDING}"
KINDS = ["assign", "access", "hex", "random"]
# (name, characters a token must consist of, alphabet). The first that fits is taken; letters and digits must both occur.
ENCODINGS = [
    ("hex", "^[0-9a-f]+$", "0123456789abcdef"),
    ("upper_hex", "^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("upper_36", "^[A-Z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    ("lower_36", "^[a-z0-9]+$", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("base62", "^[A-Za-z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64_url", "^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
]
# Largest expected share of real random tokens among those turned away, in each length class.
FALSE_DISCOVERY = 0.01
# p-values are counted in steps of 2^(-1/4), down to 2^-64.
BINS_PER_HALVING, LAST_BIN = 4, 256
MASK = "[SECRET]"


def _matches(docs: DataFrame, kind: str, pattern: str) -> DataFrame:
    """k, c, kind, n (number of the match), match, gap (code points between it and the match before)."""
    some = docs.filter(F.col("t").rlike(pattern))
    found = F.regexp_extract_all("t", F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split("t", pattern, -1), lambda g: F.length(g))
    zipped = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(m.alias("match"), g.alias("gap")))
    rows = some.select("k", "c", F.posexplode(zipped).alias("n", "x"))
    return rows.select("k", "c", F.lit(kind).alias("kind"), "n", "x.match", "x.gap")


def _located(matches: DataFrame) -> DataFrame:
    """Matches with start and end. Repeats of one row count once."""
    once = matches.repartition("k", "c").groupBy("k", "c", "kind", "n").agg(F.first("match").alias("match"), F.first("gap").alias("gap"))
    upto = Window.partitionBy("k", "c", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    ends = once.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(upto).cast("int"))
    return ends.select("k", "c", "kind", "match", (F.col("end") - F.length("match")).alias("start"), "end")


def normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution: a logistic curve, right to 0.0002, floored so that it never is zero."""
    return F.greatest(1 / (1 + F.exp(F.least(1.5976 * z + 0.07056 * z * z * z, F.lit(700.0)))), F.lit(2.0**-64))


def randomness(tokens: DataFrame, column: str = "match") -> DataFrame:
    """Battery of tests against uniform random characters of the token's inferred encoding.

    Adds encoding (null: none fits), size of its alphabet, z-scores of chi-squared uniformity, runs about the middle
    of the alphabet and serial correlation, and `p`, three times the least of their p-values, at most 1. Padding `=`
    at the end is left out. Tokens without an encoding keep null scores.
    """
    body = F.regexp_replace(F.col(column), "=+$", "")
    mixed = body.rlike("[0-9]") & body.rlike("[A-Za-z]")
    name, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    for encoding, shape, letters in reversed(ENCODINGS):
        name = F.when(mixed & body.rlike(shape), F.lit(encoding)).otherwise(name)
        alphabet = F.when(mixed & body.rlike(shape), F.lit(letters)).otherwise(alphabet)
    rows = tokens.withColumns({"body__": body, "encoding": name, "alphabet__": alphabet})
    rows = rows.withColumns({"size": F.length("alphabet__").cast("double"), "length": F.length("body__").cast("double")})
    letters = F.transform(F.sequence(F.lit(1), F.length("alphabet__")), lambda i: F.substr("alphabet__", i, F.lit(1)))
    values = F.expr("transform(split(body__, ''), c -> CAST(instr(alphabet__, c) - 1 AS DOUBLE))")
    counts = F.transform(letters, lambda c: (F.length("body__") - F.length(F.replace("body__", c, F.lit("")))).cast("double"))
    rows = rows.withColumns({"values__": F.slice(values, F.lit(1), F.length("body__")), "squares__": F.aggregate(counts, F.lit(0.0), lambda a, n: a + n * n)})
    size, length = F.col("size"), F.col("length")
    chi = size / length * F.col("squares__") - length
    free = size - 1
    # Cube-root form: close to normal for few degrees of freedom too.
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1.0) / 3) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    nexts = F.slice("values__", F.lit(2), F.greatest(F.size("values__") - 1, F.lit(0)))
    firsts = F.slice("values__", F.lit(1), F.greatest(F.size("values__") - 1, F.lit(0)))
    middle = (size - 1) / 2
    turns = F.aggregate(F.zip_with(firsts, nexts, lambda a, b: F.when((a > middle) != (b > middle), 1.0).otherwise(0.0)), F.lit(0.0), lambda x, y: x + y)
    share = F.floor(size / 2) / size
    rate = 2 * share * (1 - share)
    z_runs = (turns - (length - 1) * rate) / F.sqrt((length - 1) * rate * (1 - rate))
    products = F.aggregate(F.zip_with(firsts, nexts, lambda a, b: (a - middle) * (b - middle)), F.lit(0.0), lambda x, y: x + y)
    z_serial = products / ((size * size - 1) / 12) / F.sqrt(length - 1)
    rows = rows.withColumns({"z_chi": z_chi, "z_runs": z_runs, "z_serial": z_serial})
    least = F.least(normal_tail(F.col("z_chi")), 2 * normal_tail(F.abs("z_runs")), 2 * normal_tail(F.abs("z_serial")))
    rows = rows.withColumn("p", F.when(F.col("encoding").isNotNull(), F.least(F.lit(1.0), 3 * least)))
    return rows.drop("body__", "alphabet__", "values__", "squares__")


def turned_away(scored: DataFrame, level: float = FALSE_DISCOVERY) -> DataFrame:
    """Per length class, the first p-value bin that is turned away as not random, by step-up control at `level`.

    Classes are doublings of the length, as short tokens can't be told from random ones as surely as long ones. A class
    where many tokens fail gets a stricter cut; where none fail, nothing is turned away. Bins are at most
    LAST_BIN a class, so the windows are small at any size of the corpus.
    """
    counted = scored.groupBy("class", "bin").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("class")
    counted = counted.withColumns({"below": F.sum("n").over(whole.orderBy(F.desc("bin"))), "all": F.sum("n").over(whole)})
    limit = F.pow(F.lit(2.0), -F.col("bin") / BINS_PER_HALVING)
    return counted.filter(limit <= level * F.col("below") / F.col("all")).groupBy("class").agg(F.min("bin").alias("cut"))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", level: float = FALSE_DISCOVERY) -> DataFrame:
    """Spans of secrets: k (key), c (hash of the text), kind, start, end, in code points, end exclusive.

    Kinds `assign`, `access` and `hex` are the fixed patterns; `random` are tokens of 20 or more characters, padding
    included, that the randomness tests don't turn away and that overlap no span of a fixed pattern. Of name=value both are
    tokens of their own. A token that no single encoding can hold is tested in its longest parts that one can; these may overlap.
    """
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).withColumn("c", F.xxhash64("t"))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "random": TOKEN, "random_64": TOKEN_64}
    found = None
    for kind, pattern in patterns.items():
        own = _matches(rows, kind, pattern)
        found = own if found is None else found.unionByName(own)
    places = materialize(_located(found), "matches")
    assigned = F.length(F.regexp_extract("match", ASSIGN, 2)) >= 12
    fixed = ~F.col("kind").isin("random", "random_64")
    base = places.filter(fixed & ((F.col("kind") != "assign") | assigned)).select("k", "c", "kind", "start", "end")
    tokens = places.filter(~fixed & (F.length("match") >= LEAST_TOKEN)).withColumn("kind", F.lit("random"))
    scored = randomness(tokens).filter("encoding IS NOT NULL")
    scored = scored.withColumns(
        {"bin": F.floor(-F.log2("p") * BINS_PER_HALVING).cast("int"), "class": F.floor(F.log2("length")).cast("int")}
    )
    scored = materialize(scored.select("k", "c", "kind", "start", "end", "bin", "class"), "scored")
    # At most one row per doubling of the length.
    passed = scored.join(F.broadcast(turned_away(scored, level)), "class", "left").filter("cut IS NULL OR bin < cut")
    covered = base.select("k", "c", F.col("start").alias("s"), F.col("end").alias("e"))
    overlap = F.col("k").eqNullSafe(F.col("k2")) & (F.col("c") == F.col("c2")) & (F.col("s") < F.col("end")) & (F.col("start") < F.col("e"))
    alone = passed.join(covered.withColumnsRenamed({"k": "k2", "c": "c2"}), overlap, "left_anti")
    return base.unionByName(alone.select("k", "c", "kind", "start", "end"))


def with_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", level: float = FALSE_DISCOVERY) -> DataFrame:
    """All rows of `docs` with their columns and `spans__`, an array of (start, order of the kind, end, kind), sorted."""
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    spans = F.array_sort(F.collect_set(F.struct("start", order.cast("int").alias("order"), "end", "kind")))
    grouped = materialize(find_secrets(docs, key, text, level).groupBy("k", "c").agg(spans.alias("spans__")), "spans")
    grouped = grouped.withColumnsRenamed({"k": "k__", "c": "c__"})
    content = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    joined = docs.withColumn("content__", content).join(grouped, F.col(key).eqNullSafe(F.col("k__")) & (F.col("content__") == F.col("c__")), "left")
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    return joined.withColumn("spans__", F.coalesce("spans__", none)).drop("k__", "c__", "content__")


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", level: float = FALSE_DISCOVERY) -> DataFrame:
    """One row per document: key, n_assign, n_access, n_hex, n_random, base_sha256, spans.

    `spans` lists kind:start:end by start, then by kind in the order of KINDS, joined by commas; `base_sha256` is the
    SHA-256 of that list without the random tokens. Null text is empty. Rows are kept one for one, repeated rows too.
    """
    rows = with_spans(docs.select(key, text), key, text, level)
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans__", lambda s: s["kind"] != "random")
    kinds = F.transform("spans__", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select(key, *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans__")).alias("spans"))


def redact_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", mask: str = MASK, level: float = FALSE_DISCOVERY) -> DataFrame:
    """All documents with their columns; each stretch covered by spans is replaced by `mask`, other text is unchanged."""
    found = with_spans(docs, key, text, level)
    value = F.col(text)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(state: Column, span: Column) -> Column:
        fresh = F.array(F.substr(value, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0))), F.lit(mask))
        parts = F.when((span["start"] >= state["at"]) & ((span["start"] > state["at"]) | (state["at"] == 0)), F.concat(state["parts"], fresh)).otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), parts.alias("parts"))

    cut = F.aggregate("spans__", start, add, lambda s: F.concat(F.array_join(s["parts"], ""), F.substr(value, s["at"] + 1, F.length(value))))
    return found.withColumn(text, F.when(F.size("spans__") > 0, cut).otherwise(value)).select(*docs.columns)
