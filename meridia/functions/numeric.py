"""Numeric functions over Columns. Rounding is Spark's (half up); a missing or non-finite value is null throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnLike, _c


def finite(x: ColumnLike) -> Column:
    """A number, or null for blanks, text, NaN and infinities."""
    v = _c(x).try_cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), None).otherwise(v)


def first_number(x: ColumnLike) -> Column:
    """The first number in a text, thousands separators ignored."""
    return F.regexp_extract(F.replace(_c(x).cast("string"), F.lit(","), F.lit("")), r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?", 0).try_cast("double")


def log2_plus_one(x: ColumnLike) -> Column:
    """log2(x + 1), missing as 0."""
    return F.log2(F.coalesce(_c(x), F.lit(0.0)) + 1)


def log2_plus_one_strict(x: ColumnLike) -> Column:
    """log2(x + 1); null for missing, non-finite and negative values."""
    v = finite(x)
    return F.when(v >= 0, F.log2(v + 1))


def log2_ratio(a: ColumnLike, b: ColumnLike, pseudo: float = 1e-4) -> Column:
    """log2 of a over b, with a pseudocount on both."""
    return F.log2((_c(a) + pseudo) / (_c(b) + pseudo))


def clamped(x: ColumnLike) -> Column:
    """Within 0 and 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), _c(x)))


def share(a: ColumnLike, b: ColumnLike) -> Column:
    """a / b, null where b is 0 or missing."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def allele_fraction(alt: ColumnLike, ref: ColumnLike) -> Column:
    """alt / (alt + ref) of two numbers whose sum is positive, else null."""
    a, r = finite(alt), finite(ref)
    return F.when(a + r > 0, a / (a + r))


def bins(length: ColumnLike, width: int) -> Column:
    """How many bins of a width cover a length."""
    return F.ceil(_c(length) / width).cast("long")


def interior_start(start: ColumnLike, length: ColumnLike, width: int, far: int = 1_000_000) -> Column:
    """The 1-based start of a window placed inside a region, at most `far` bases in."""
    return (_c(start) + F.least(F.lit(far), F.greatest(F.lit(0), _c(length) - width - 1)) + 1).cast("long")


def micro_usd(x: ColumnLike) -> Column:
    """An amount in dollars to six places."""
    return _c(x).cast("decimal(18,6)")


def budget_state(spent: ColumnLike, reserved: ColumnLike, limit: float, stop: float) -> Column:
    """`stop` at the stop line, `limit` at the limit with what is reserved, else `within`."""
    return F.when(_c(spent) >= stop, "stop").when(_c(spent) + _c(reserved) >= limit, "limit").otherwise("within")


def throughput_mb(size: ColumnLike, seconds: ColumnLike) -> Column:
    """MB a second to two places; at least a millisecond counts."""
    return F.round(_c(size) / 1e6 / F.greatest(F.lit(0.001), _c(seconds)), 2)


def eta_seconds(total: ColumnLike, done: ColumnLike, rate: ColumnLike) -> Column:
    """Seconds to go at a rate; null at rate 0."""
    return F.when(_c(rate) > 0, F.greatest(F.lit(0), _c(total) - _c(done)) / _c(rate))


def shown_bytes(x: ColumnLike) -> Column:
    """A size with its unit, one place from KiB on."""
    n, out = _c(x).cast("double"), None
    for unit, size in (("TiB", 2**40), ("GiB", 2**30), ("MiB", 2**20), ("KiB", 2**10)):
        one = F.format_string(f"%.1f {unit}", n / size)
        out = F.when(n >= size, one) if out is None else out.when(n >= size, one)
    return out.otherwise(F.format_string("%d B", _c(x).cast("long")))


def byte_ranges(size: ColumnLike, part: int) -> Column:
    """array of struct(number, first, last): inclusive ranges of at most `part` bytes, numbered from 1."""
    n = _c(size).cast("long")
    starts = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1, F.lit(part).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.transform(starts, lambda s, i: F.struct((i + 1).cast("int").alias("number"), s.alias("first"), (F.least(s + part, n) - 1).alias("last")))


def burden_support(p: ColumnLike) -> Column:
    """struct(label, component) of a burden test's best p."""
    strong, nominal, none = (F.struct(F.lit(a).alias("label"), F.lit(b).alias("component")) for a, b in (("strong", 1.0), ("nominal", 0.6), ("none", 0.0)))
    return F.when(_c(p) < 2.5e-6, strong).when(_c(p) < 0.05, nominal).otherwise(none)


def locus_score(l2g: ColumnLike, coloc: ColumnLike, eqtl: ColumnLike, burden: ColumnLike, coding: ColumnLike) -> Column:
    """The weighted score of five kinds of evidence; colocalisation counts only with a locus-to-gene score."""
    a = clamped(l2g)
    b = F.when(a <= 0, 0.0).otherwise(clamped(coloc))
    return clamped(a * 0.40 + b * 0.25 + clamped(eqtl) * 0.15 + clamped(burden) * 0.10 + clamped(coding) * 0.10)
