"""Scalar column expressions (all JVM-side, codegen-friendly; no Python UDFs)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = 4503599627370496.0


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(mapping: Mapping) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))


def lookup(c: str | Column, mapping: Mapping) -> Column:
    """mapping[c]; missing key or null -> null (no ANSI error)."""
    c = col(c)
    if not mapping:
        return F.lit(None)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.try_element_at(literal_map(mapping), c))


def level_position(c: str | Column, levels: Sequence[str], unknown: int = -1) -> Column:
    """Ordinal code = position of the value in ``levels``; unknown or null -> ``unknown``."""
    return F.coalesce(lookup(col(c).cast("string"), {lv: i for i, lv in enumerate(levels)}), F.lit(unknown))


def null_safe_clip(c: str | Column, lower, upper) -> Column:
    """Clip to [lower, upper]; a null stays null (bare least/greatest would return the fence)."""
    c = col(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(F.greatest(c, F.lit(lower)), F.lit(upper)))


def try_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double; division by zero -> null (ANSI-safe)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def ratio_plus_one(num: str | Column, den: str | Column) -> Column:
    return F.try_divide(col(num).cast("double"), col(den).cast("double") + F.lit(1.0))


def flag(c: str | Column, value: str) -> Column:
    """1 when c == value, else 0 (null -> 0)."""
    return F.coalesce((col(c) == F.lit(value)).cast("int"), F.lit(0))


def seeded_md5(seed: int | str, *parts: str | Column) -> Column:
    pieces = [F.lit(str(seed))] + [col(p).cast("string") for p in parts]
    return F.md5(F.concat_ws(":", *pieces))


def md5_uniform(md5_hex: Column, offset: int = 0) -> Column:
    """Uniform [0,1) from 13 hex digits (52 bits, exact in a double) of an md5 string (same in DuckDB:
    ``('0x' || substr(h, offset+1, 13))::bigint / 2^52``)."""
    return F.conv(F.substring(md5_hex, offset + 1, 13), 16, 10).cast("long") / F.lit(TWO_POW_52)


def md5_bucket(md5_hex: Column, hex_digits: int = 4) -> Column:
    """Monotone bucket id (0 .. 16^digits-1) from the md5 prefix: rank order by md5 is
    preserved, so bucket b holds exactly the hashes between its neighbours."""
    return F.conv(F.substring(md5_hex, 1, hex_digits), 16, 10).cast("int")


def sorted_bucket(c: str | Column, bounds: Sequence[float]) -> Column:
    """Number of bounds <= c, written as a balanced if-else tree (binary search, depth
    log2(len(bounds))) so it stays a codegen expression.  ``bounds`` must be sorted."""
    c = col(c)
    bounds = list(bounds)

    def build(lo: int, hi: int) -> Column:
        # result lies in [lo, hi]; bounds[lo:hi] decide it
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c < F.lit(bounds[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))

    return build(0, len(bounds))


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
