"""Bytes as column expressions: little-endian numbers, LEB128, row-binary fields, TSV fields, quoted base64."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def byte_at(data: Column, at: int | Column) -> Column:
    """The byte at a place counted from 0, as a bigint; null beyond the end."""
    place = at if isinstance(at, Column) else F.lit(at)
    one = F.substring(data, place + 1, F.lit(1))
    return F.when(F.octet_length(one) == 1, F.ascii(F.decode(one, "ISO-8859-1")).cast("bigint"))


def byte_or_zero(data: Column, at: int | Column) -> Column:
    """The byte at a place; 0 beyond the end, as arrays of some engines read."""
    return F.coalesce(byte_at(data, at), F.lit(0).cast("bigint"))


def le_uint(data: Column, at: int, width: int) -> Column:
    """An unsigned little-endian number of width bytes (8 bytes: as a signed bit pattern)."""
    out = byte_at(data, at)
    for k in range(1, width):
        out = out.bitwiseOR(F.shiftleft(byte_at(data, at + k), 8 * k))
    return out


def to_le(value: Column, width: int) -> Column:
    """The width low bytes of an integer, little-endian."""
    number = value.cast("bigint")
    return F.unhex(F.concat(*[F.lpad(F.hex(F.shiftrightunsigned(number, 8 * k).bitwiseAND(F.lit(255))), 2, "0") for k in range(width)]))


def leb128(value: Column) -> Column:
    """LEB128 of 0 up to 2**63 - 1; other numbers raise."""
    number = value.cast("bigint")
    groups = []
    for k in range(9):
        low = F.shiftrightunsigned(number, 7 * k).bitwiseAND(F.lit(127))
        more = F.shiftrightunsigned(number, 7 * k + 7) > 0 if k < 8 else F.lit(False)
        byte = F.lpad(F.hex(F.when(more, low.bitwiseOR(F.lit(128))).otherwise(low)), 2, "0")
        groups.append(byte if not k else F.when(F.shiftrightunsigned(number, 7 * k) > 0, byte))
    code = F.when(number.isNotNull(), F.unhex(F.concat_ws("", *groups)))
    return F.when(number < 0, F.raise_error(F.lit("LEB128 of a negative number"))).otherwise(code)


def leb128_length(data: Column) -> Column:
    """How many bytes the LEB128 number at the start of data has; null if it doesn't end within nine."""
    out = F.lit(None).cast("int")
    for k in reversed(range(9)):
        out = F.when(byte_at(data, k) < 128, F.lit(k + 1)).otherwise(out)
    return out


def leb128_value(data: Column) -> Column:
    """The LEB128 number at the start of data; null if it doesn't end within nine bytes."""
    out = F.lit(None).cast("bigint")
    for k in reversed(range(9)):
        byte = byte_at(data, k)
        rest = F.shiftleft(byte.bitwiseAND(F.lit(127)), 7 * k)
        out = F.when(byte < 128, rest).otherwise(rest.bitwiseOR(out))
    return out


def strip_leb128(data: Column) -> Column:
    """What follows a length prefix, which must be the true length."""
    n = leb128_length(data)
    rest = F.substring(data, n + 1, F.length(data))
    return F.when(F.length(rest) == leb128_value(data), rest).otherwise(F.raise_error(F.lit("a wrong length prefix")))


def prefixed(data: Column) -> Column:
    """Bytes behind their LEB128 length."""
    return F.concat(leb128(F.octet_length(data)), data)


# ---- row-binary fields


def rb_string(value: Column) -> Column:
    return prefixed(F.encode(value, "UTF-8"))


def rb_nullable_string(value: Column) -> Column:
    return F.when(value.isNull(), F.unhex(F.lit("01"))).otherwise(F.concat(F.unhex(F.lit("00")), rb_string(value)))


def rb_datetime(value: Column) -> Column:
    """Whole seconds since 1970 (UTC) as an unsigned 32-bit number; other times raise."""
    seconds = F.unix_seconds(value.cast("timestamp"))
    return F.when(seconds.between(0, (1 << 32) - 1), to_le(seconds, 4)).otherwise(F.raise_error(F.lit("a time outside 32 bits")))


def rb_int64(value: Column) -> Column:
    return to_le(value, 8)


@F.pandas_udf(T.BinaryType())
def rb_float64(value: pd.Series) -> pd.Series:
    return value.map(lambda v: None if pd.isna(v) else struct.pack("<d", v))


def rb_row(*fields: Column) -> Column:
    return F.concat(*fields)


# ---- text fields


def tsv_field(value: Column) -> Column:
    out = value.cast("string")
    for plain, escaped in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    return F.coalesce(out, F.lit("\\N"))


def tsv_row(*values: Column) -> Column:
    return F.concat_ws("\t", *[tsv_field(v) for v in values])


def unquoted_base64(value: Column) -> Column:
    """The bytes of base64 that may stand in double quotes."""
    return F.unbase64(F.regexp_replace(value, '^"+|"+$', ""))


# ---- packing by expressions alone


def pack5(registers: Column, count: int) -> Column:
    """An array of count numbers of five bits each as bytes, lowest bit first; each byte gathers from three of them at most."""
    at = lambda i: F.coalesce(F.get(registers, i), F.lit(0)).cast("bigint")

    def byte(b: Column) -> Column:
        first = F.floor(b * 8 / 5).cast("int")
        three = at(first).bitwiseOR(F.shiftleft(at(first + 1), 5)).bitwiseOR(F.shiftleft(at(first + 2), 10))
        return F.lpad(F.hex(F.call_function("shiftright", three, (b * 8 - first * 5).cast("int")).bitwiseAND(F.lit(255))), 2, "0")

    return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(count * 5 // 8 - 1)), byte), ""))


def hll12_bytes(registers: Column) -> Column:
    """A dense 12-bit state of an array of 4096 ranks, by expressions alone: type, registers, histogram, zeros."""
    def count(rank: int) -> Column:
        return F.size(F.filter(registers, lambda v: v >= rank if rank == 21 else v == rank))

    counts = [count(r) for r in range(22)]
    capped = F.transform(registers, lambda v: F.least(v, F.lit(21)))
    return F.concat(F.unhex(F.lit("01")), pack5(capped, 4096), *[to_le(c, 4) for c in counts], to_le(counts[0], 2))
