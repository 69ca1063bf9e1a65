from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


def days(n: int, step: int = 1, start: date = date(2020, 1, 1)) -> list[date]:
    return [start + timedelta(days=i * step) for i in range(n)]


def long_frame(spark, values: dict[str, list], step: int = 1):
    """A long table from lists of values; None leaves the day out."""
    rows = [(s, d, None if v is None else float(v)) for s, vs in values.items() for d, v in zip(days(len(vs), step), vs, strict=True) if v is not None]
    return spark.createDataFrame(rows, "series_id string, observation_date date, value double")


def same_as_sql(df, sql: str, sf_dir: str = SF) -> None:
    """The rows of a query and of its SQL, whatever their order."""
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{sf_dir}/{t}.parquet'")
    want = con.sql(sql)
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    rows = lambda found, names: sorted(tuple(repr(r[names.index(c)]) for c in order) for r in found)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(want.fetchall(), want.columns)


class Clock:
    """A clock that moves a minute at each look."""

    def __init__(self, start: datetime = datetime(2024, 1, 1, tzinfo=UTC)):
        self.now = start

    def __call__(self) -> datetime:
        self.now += timedelta(minutes=1)
        return self.now
