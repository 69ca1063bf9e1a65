"""Row digests and the compatibility of a replica with its source."""

from __future__ import annotations

import struct
from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalars import DIGEST_PREFIX, row_digest

KEY = "timestamp_m1"
#: Fixed values: (schema, feature) versions from which a replica may move to which. None stands for any equal feature version.
UPGRADES = (((1, None), (2, None)), ((2, 1), (3, 2)), ((3, 2), (4, 3)))


def digests(frame: DataFrame, key: str = KEY) -> DataFrame:
    """(key, row_sha256) of every row."""
    return frame.select(key, row_digest(F.col(key), [c for c in frame.columns if c != key], key).alias("row_sha256"))


def row_bytes(key: datetime, values: Sequence[tuple[str, float | None]], key_name: str = KEY) -> bytes:
    """What a row's digest is taken of; a helper for tests and for looking at single rows."""
    micros = (key.astimezone(UTC) - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)
    cells = [name.encode() + b"\0" + (b"N" if x is None else b"F" + struct.pack(">d", x + 0.0)) for name, x in values]
    return DIGEST_PREFIX + key_name.encode() + b"\0T" + struct.pack(">q", micros) + b"".join(cells)


def summary(frame: DataFrame, key: str = KEY) -> DataFrame:
    return frame.agg(F.count("*").alias("row_count"), F.min(key).alias("min_timestamp"), F.max(key).alias("max_timestamp"))


def table_digest(digested: DataFrame, key: str = KEY) -> str:
    """One digest of all row digests that doesn't depend on their order or how they are dealt out."""
    parts = [F.sum(F.conv(F.substring("row_sha256", 1 + 8 * k, 8), 16, 10).cast("decimal(20,0)")).alias(f"p{k}") for k in range(8)]
    return digested.agg(*parts, F.count("*").alias("n")).select(F.sha2(F.concat_ws(",", *[F.coalesce(F.col(f"p{k}").cast("string"), F.lit("0")) for k in range(8)], F.col("n").cast("string")), 256)).first()[0]


def may_move(before: tuple[int, int], after: tuple[int, int]) -> bool:
    """Whether a replica of one pair of versions may take a source of the other; anything not listed may not."""
    if before == after:
        return True
    for (s, f), (t, g) in UPGRADES:
        if (before[0], after[0]) == (s, t) and (before[1] == after[1] if f is None else (before[1], after[1]) == (f, g)):
            return True
    return False


def columns_change(before: tuple[int, int], after: tuple[int, int]) -> bool:
    """Whether moving adds columns, so that the replica's rows can't be compared with their digests beforehand."""
    return any((before, after) == pair for pair in UPGRADES if None not in pair[0])


def upgradable(schema_version: Column, feature_version: Column, to_schema: int, to_feature: int) -> Column:
    """The same rule over a table of replicas."""
    ok = (schema_version == to_schema) & (feature_version == to_feature)
    for (s, f), (t, g) in UPGRADES:
        if t == to_schema and f is None:
            ok = ok | ((schema_version == s) & (feature_version == to_feature))
        elif (t, g) == (to_schema, to_feature):
            ok = ok | ((schema_version == s) & (feature_version == f))
    return ok
