"""Integer and bit-flag expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: alignment flag bits
PAIRED = 0x1
PROPER = 0x2
UNMAPPED = 0x4
MATE_UNMAPPED = 0x8
REVERSE = 0x10
MATE_REVERSE = 0x20
MATE_1 = 0x40
MATE_2 = 0x80
SECONDARY = 0x100
QC_FAIL = 0x200
DUPLICATE = 0x400
SUPPLEMENTARY = 0x800


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(a: str | Column, b: int | Column) -> Column:
    """Integer quotient as bigint, without a detour through double."""
    return F.call_function("div", col(a), F.lit(b) if isinstance(b, int) else b)


def has_all(flag: str | Column, mask: int) -> Column:
    return col(flag).bitwiseAND(F.lit(mask)) == F.lit(mask)


def has_any(flag: str | Column, mask: int) -> Column:
    return col(flag).bitwiseAND(F.lit(mask)) != F.lit(0)


def count_flag(flag: str | Column, mask: int) -> Column:
    return F.count_if(has_any(flag, mask))
