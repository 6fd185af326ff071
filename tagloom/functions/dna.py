"""Column functions on sequences and qualities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FROM, _TO = "ACGTNacgtn", "TGCANtgcan"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def revcomp(seq: Column | str) -> Column:
    return F.translate(F.reverse(_col(seq)), _FROM, _TO)


def hamming(a: Column | str, b: Column | str) -> Column:
    """Mismatches of two strings of equal length; null when lengths differ."""
    a, b = _col(a), _col(b)
    steps = F.sequence(F.lit(1), F.length(a))
    total = F.aggregate(
        steps,
        F.lit(0),
        lambda acc, i: acc + (F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1))).cast("int"),
    )
    return F.when(F.length(a) != F.length(b), F.lit(None)).when(F.length(a) == 0, 0).otherwise(total)


def levenshtein_within(a: Column | str, b: Column | str, d: int) -> Column:
    """True when the edit distance is at most d."""
    return F.levenshtein(_col(a), _col(b), d) >= 0


def n_mask(length: int | Column) -> Column:
    return F.repeat(F.lit("N"), length if isinstance(length, Column) else F.lit(length))


def phred(c: Column | str) -> Column:
    return F.ascii(_col(c)) - 33


def extract_section(seq: Column | str, start, length, shift=0) -> Column:
    """Section at a 0-based start, moved by `shift`; null when it starts before the read."""
    seq = _col(seq)
    if all(isinstance(v, int) for v in (start, length, shift)):
        at = start + shift
        return F.substring(seq, at + 1, length) if at >= 0 else F.lit(None).cast("string")
    start, length, shift = [v if isinstance(v, Column) else F.lit(v) for v in (start, length, shift)]
    at = start + shift
    return F.when(at >= 0, F.substr(seq, at + 1, length))


def strand_section(seq: str, base: str, sign: str, at: str, rel, length) -> Column:
    """Section of the strand being read, taken from the read as it is and left unreversed.

    Arguments are SQL texts. `base` is the anchor in read coordinates and `sign` +1 or -1 for the
    strand; `at` is the section start on the strand, `rel` the same relative to the anchor. A section
    cut off by the read end is shorter. One SQL text instead of a tree of column calls: a decode plan
    holds many sections, and building them call by call takes longer than planning them.
    """
    raw = f"({base} + {sign} * ({rel}) + IF({sign} < 0, -({length}), 0))"
    return F.expr(
        f"IF({at} >= 0, substr({seq}, greatest({raw}, 0) + 1, {length} + least({raw}, 0)), NULL)"
    )
