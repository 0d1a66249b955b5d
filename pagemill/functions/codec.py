"""Encodings, hash-ring arithmetic and bit fields as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The alphabets of the two base-64 forms, in the order of their digits.
URL_SAFE = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
STANDARD = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: The digits in an order in which strings sort as bytes do.
SORTABLE = "".join(sorted(URL_SAFE))
LONG_MAX = 2**63 - 1


def b64_encode(data: Column) -> Column:
    """URL-safe base 64 without padding, of a binary or the bytes of a string."""
    return F.regexp_replace(F.translate(F.regexp_replace(F.base64(data.cast("binary")), r"[\r\n]", ""), "+/", "-_"), "=+$", "")


def b64_decode(s: Column) -> Column:
    padded = F.concat(F.translate(s, "-_", "+/"), F.repeat(F.lit("="), F.pmod(-F.length(s), F.lit(4)).cast("int")))
    return F.unbase64(padded)


def b64_well_formed(s: Column) -> Column:
    return s.rlike("^[A-Za-z0-9_-]*$")


def b64_sort_key(s: Column) -> Column:
    """A string whose plain order is the order of the base-64 digits; malformed ones come last."""
    return F.when(b64_well_formed(s), F.translate(s, URL_SAFE, SORTABLE)).otherwise(F.concat(F.lit("~"), s))


def b64_to_long(s: Column) -> Column:
    digits = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda i: _digit(s, i))
    return F.aggregate(digits, F.lit(0).cast("long"), lambda acc, d: acc * 64 + d)


def _digit(s: Column, i: Column) -> Column:
    return (F.call_function("instr", F.lit(URL_SAFE), F.substring(s, i.cast("int"), F.lit(1))) - 1).cast("long")


def long_to_b64(n: Column, width: int) -> Column:
    """So many digits, the highest first."""
    parts = [F.call_function("substring", F.lit(URL_SAFE), (F.shiftrightunsigned(n, 6 * k).bitwiseAND(63) + 1).cast("int"), F.lit(1)) for k in range(width - 1, -1, -1)]
    return F.concat(*parts)


def b64_cardinal(s: Column) -> Column:
    """The first ten digits as 60 bits, moved up by three with these set: a place on the ring of non-negative longs."""
    padded = F.substring(F.rpad(s, 10, "A"), 1, 10)
    return F.shiftleft(b64_to_long(padded), 3).bitwiseOR(7)


def b64_uncardinal(n: Column) -> Column:
    return long_to_b64(F.shiftrightunsigned(n, 3), 10)


def ring_distance(start: Column, end: Column) -> Column:
    """Steps upwards from start to end, over the top of the ring if need be."""
    return F.when(end >= start, end - start).otherwise(F.lit(LONG_MAX) - start + end + 1)


def vertical_partition(position: Column, exponent: int) -> Column:
    """Which of 2 ** exponent equal parts of the ring a place lies in."""
    return F.shiftrightunsigned(position, 63 - exponent).cast("int") if exponent else F.lit(0)


def ring_partition_place(word_position: Column, partition: Column, exponent: int) -> Column:
    """The place of a word within a given part."""
    return F.shiftrightunsigned(word_position, exponent).bitwiseOR(F.call_function("shiftleft", partition.cast("long"), F.lit(63 - exponent)))


def order_partition(position: Column, forks: int) -> Column:
    return F.floor(position / F.lit(LONG_MAX // forks)).cast("int")


def big_endian(n: Column, width: int = 8) -> Column:
    """The low bytes of a long, the highest first."""
    return F.unhex(F.lpad(F.substring(F.lpad(F.hex(n.cast("long")), 16, "0"), 17 - 2 * width, 2 * width), 2 * width, "0"))


def bit_length(n: Column) -> Column:
    """Position of the highest set bit, 0 for 0."""
    return F.when(n > 0, F.length(F.bin(n.cast("long"))) - 1).otherwise(0).cast("int")


def bit_set(field: Column, bit: int, value: bool = True) -> Column:
    return field.bitwiseOR(F.lit(1 << bit).cast("long")) if value else field.bitwiseAND(F.lit(~(1 << bit)).cast("long"))


def bit_get(field: Column, bit: int) -> Column:
    return F.getbit(field.cast("long"), F.lit(bit)) == 1


def rotated_order(key: Column, zero: Column) -> list[Column]:
    """Sort columns of an order that begins at zero and wraps around."""
    return [(key < zero).asc(), key.asc()]


def protocol_list(protocols: Column) -> Column:
    """Places (from 1, of the others than http) with their names, as 001-https; http itself is left out."""
    numbered = F.transform(protocols, lambda p, i: F.struct(i.alias("i"), p.alias("p")))
    return F.transform(F.filter(numbered, lambda x: x["p"] != "http"), lambda x: F.concat(F.lpad(x["i"].cast("string"), 3, "0"), F.lit("-"), x["p"]))


def protocols_of(indexed: Column, size: Column) -> Column:
    """The list again, http where nothing is noted."""
    return F.when(size > 0, F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.coalesce(
        F.try_element_at(F.transform(F.filter(indexed, lambda s: F.substring(s, 1, 3).try_cast("int") == i), lambda s: F.substring(s, 5, 100)), F.lit(1)), F.lit("http")))).otherwise(F.expr("cast(array() as array<string>)"))
