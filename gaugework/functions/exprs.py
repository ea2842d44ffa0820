"""Column expressions. All of them stay on the JVM side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double; NULL where the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """As :func:`ratio`, with 0 in place of NULL."""
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def hash_order(seed: int, key: Column) -> Column:
    """Reproducible random order: the MD5 of ``seed:key``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def tile_of(rank: Column, rows: Column, tiles: int) -> Column:
    """The NTILE tile of 1-based ``rank`` among ``rows`` rows.

    The first ``rows % tiles`` tiles hold one row more than the others.
    """
    base = F.floor(rows / F.lit(tiles))
    extra = rows % F.lit(tiles)
    wide_rows = extra * (base + 1)
    in_wide = F.floor((rank - 1) / (base + 1)) + 1
    in_narrow = F.floor((rank - 1 - wide_rows) / F.greatest(base, F.lit(1))) + 1 + extra
    return F.when(rank <= wide_rows, in_wide).otherwise(in_narrow).cast("bigint")


def normalise_label(
    label: Column, mapping: Mapping[str, str], else_label: str | None = None
) -> Column:
    """Map raw labels to canonical ones.

    Canonical labels pass through. An unknown or NULL label raises, unless ``else_label``
    is given: then every label outside the mapping's keys becomes ``else_label``.
    """
    mapped = reduce(
        lambda acc, pair: acc.when(label == pair[0], F.lit(pair[1])),
        mapping.items(),
        F.when(F.lit(False), F.lit(None).cast("string")),
    )
    if else_label is not None:
        return mapped.otherwise(F.lit(else_label))
    known = label.isin(*set(mapping.values()))
    return mapped.when(known, label).otherwise(
        F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(label, F.lit("NULL"))))
        .cast("string")
    )


def prob_of(probs: Column, label: Column) -> Column:
    """Probability of ``label`` in a ``map<string,double>``; NULL if it is missing."""
    return F.try_element_at(probs, label)


def prob_in_array(pairs: Column, label: Column) -> Column:
    """Probability of ``label`` in an ``array<struct<label,prob>>``; NULL if it is missing."""
    return F.get(F.filter(pairs, lambda p: p["label"] == label), F.lit(0))["prob"]


def log_loss_term(p_true: Column, eps: float = 1e-15) -> Column:
    """-ln of the clipped probability of the true class (a missing class counts as 0)."""
    p = F.coalesce(p_true, F.lit(0.0))
    return -F.log(F.greatest(F.least(p, F.lit(1.0 - eps)), F.lit(eps)))


def any_outside(ranges: Mapping[str, tuple[float, float]]) -> Column:
    """True where any of the named columns lies outside its closed range."""
    return reduce(
        lambda a, b: a | b,
        [(F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi)) for c, (lo, hi) in ranges.items()],
    )


def euclidean(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Euclidean distance, summed in the given column order."""
    return F.sqrt(_sum_squares([x - y for x, y in zip(a, b)]))


def box_gap(lo_a, hi_a, lo_b, hi_b) -> Column:
    """Smallest distance between two axis-aligned boxes (a point is a box with lo = hi).

    Rounding is monotone and the summation order is that of :func:`euclidean`, so the gap
    never exceeds the computed distance of any two points of the boxes.
    """
    zero = F.lit(0.0)
    return F.sqrt(_sum_squares([
        F.greatest(lb - ha, la - hb, zero) for la, ha, lb, hb in zip(lo_a, hi_a, lo_b, hi_b)
    ]))


def box_reach(lo_a, hi_a, lo_b, hi_b) -> Column:
    """Largest distance between a point of one box and a point of the other."""
    return F.sqrt(_sum_squares([
        F.greatest(hb - la, ha - lb) for la, ha, lb, hb in zip(lo_a, hi_a, lo_b, hi_b)
    ]))


def _sum_squares(parts: Sequence[Column]) -> Column:
    return reduce(lambda s, p: s + p, [p * p for p in parts])


def days_after(ts: Column, days: Column) -> Column:
    """``ts`` plus a number of days, as a day-time interval."""
    return ts + F.make_dt_interval(days.cast("int"))


def split_tags(tags: Column) -> Column:
    """Comma-separated tag text to ``array<string>``, trimmed, without empty parts."""
    parts = F.transform(F.split(tags, ","), lambda t: F.trim(t))
    return F.filter(parts, lambda t: F.length(t) > 0)
