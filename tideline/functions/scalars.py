"""Scalar expressions: everything here is a Column of built-in functions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_INF = float("inf")


def first_date(text: Column, formats: Sequence[str]) -> Column:
    """The date by the first format that fits; null where none does."""
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def number(text: Column) -> Column:
    """A double, or null where the text isn't one."""
    return text.try_cast("double")


def missing(text: Column) -> Column:
    """Null, or one of the markers for a missing value."""
    return text.isNull() | F.trim(text).isin("", ".")


def finite(x: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite; never null."""
    return F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(_INF)), F.lit(False))


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Null unless the denominator is over 0."""
    return F.when(denominator > 0, numerator / denominator)


def all_of(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def any_of(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def valid_bar(open_: Column, high: Column, low: Column, close: Column) -> Column:
    """Finite, not negative, and the high and low bounding open and close."""
    each = (open_, high, low, close)
    return all_of([finite(x) & (x >= 0) for x in each]) & (high >= low) & (high >= F.greatest(open_, close)) & (low <= F.least(open_, close))


def any_null(names: Sequence[str]) -> Column:
    return any_of([F.col(c).isNull() for c in names])


def midnight(day: Column) -> Column:
    """The day's first instant, in the session's time zone, which is UTC."""
    return day.cast("timestamp")


def iso_utc(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def build_id(at: Column) -> Column:
    return F.date_format(at, "yyyyMMdd'T'HHmmss'Z'")


def is_build_id(text: Column) -> Column:
    """A build id that reads back as itself, so that 20240230T000000Z isn't one."""
    at = F.try_to_timestamp(text, F.lit("yyyyMMdd'T'HHmmss'Z'"))
    return F.coalesce(text.rlike("^[0-9]{8}T[0-9]{6}Z$") & (build_id(at) == text), F.lit(False))


def is_sha256(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9a-f]{64}$"), F.lit(False))


def redacted(text: Column, secrets: Sequence[str]) -> Column:
    return reduce(lambda x, secret: F.replace(x, F.lit(secret), F.lit("***")), [s for s in secrets if s], text)


def path_only(url: Column) -> Column:
    """Scheme, host and path of a url, without user, query and fragment."""
    return F.concat(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(url, F.lit("HOST")), F.try_parse_url(url, F.lit("PATH")))


def unsigned_zero(x: Column) -> Column:
    return F.when(x == 0, F.lit(0.0)).otherwise(x)


def double_hex(x: Column) -> Column:
    """The 16 hexadecimal digits of a finite double's IEEE 754 bits, most significant first.

    Java's %a writes a double exactly: 0x1.<fraction>p<exponent>, and 0x0.<fraction>p-1022 below the least normal one.
    """
    text = F.format_string("%a", F.abs(x))
    fraction = F.rpad(F.substring_index(F.substring_index(text, "p", 1), ".", -1), 13, "0")
    exponent = F.when(F.substring(text, 3, 1) == "1", F.substring_index(text, "p", -1).cast("int") + 1023).otherwise(0)
    return F.concat(F.lower(F.lpad(F.hex(exponent + F.when(x < 0, 2048).otherwise(0)), 3, "0")), fraction)


def long_hex(x: Column) -> Column:
    """The 16 hexadecimal digits of a 64-bit integer in two's complement."""
    return F.lower(F.lpad(F.hex(x.cast("long")), 16, "0"))


#: What every row digest begins with.
DIGEST_PREFIX = b"tideline:row:v2\x00"


def row_digest(key: Column, values: Sequence[str], key_name: str = "timestamp_m1") -> Column:
    """SHA-256 of a row's bytes: a prefix; the key's name, 0, T and its microseconds as a 64-bit integer; then for each column its name, 0, and N for null or F and the double's 8 bytes. All numbers are big-endian.

    NaN and infinite numbers are refused: the query fails. -0.0 is 0.0. serving.row_bytes makes the same bytes of one row in Python.
    """
    framed = lambda name, tag: name.encode().hex() + "00" + tag.encode().hex()
    head = F.concat(F.lit(DIGEST_PREFIX.hex() + framed(key_name, "T")), long_hex(F.unix_micros(key)))
    if not values:
        return F.sha2(F.unhex(head), 256)
    names = F.array(*[F.lit(name.encode().hex() + "00") for name in values])

    def cell(x: Column, i: Column) -> Column:
        refused = F.raise_error(F.concat(F.lit("neither null nor finite: value "), (i + 1).cast("string"))).cast("string")
        return F.concat(F.element_at(names, i + 1), F.when(x.isNull(), F.lit("4e")).when(~finite(x), refused).otherwise(F.concat(F.lit("46"), double_hex(unsigned_zero(x)))))

    cells = F.transform(F.array(*[F.col(name).cast("double") for name in values]), cell)
    return F.sha2(F.unhex(F.concat(head, F.array_join(cells, ""))), 256)


def months_of(day: Column) -> tuple[Column, Column]:
    """Year and month as zero-padded strings, the names of monthly partitions."""
    return F.date_format(day, "yyyy"), F.date_format(day, "MM")


def edge(x: Column, digits: int = 6) -> Column:
    """A value as reports show it: rounded, and never -0.0."""
    return F.round(x, digits) + F.lit(0.0)
