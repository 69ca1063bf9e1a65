import math
from statistics import pstdev

import pytest
from helpers import long_frame
from pyspark.sql import functions as F

from tideline.operators import features as X


def column(df, name, series="a"):
    return [r[0] for r in df.where(F.col("series_id") == series).orderBy("observation_date").select(name).collect()]


def test_deltas_count_observations_not_days(spark):
    df = X.with_deltas(long_frame(spark, {"a": [i + 1 for i in range(25)]}, step=3))
    assert column(df, "delta_1obs") == [None] + [1.0] * 24
    assert column(df, "delta_5obs") == [None] * 5 + [5.0] * 20
    gapped = X.with_deltas(long_frame(spark, {"a": [i + 1 if i not in (2, 4, 6) else None for i in range(12)]}))
    assert column(gapped, "delta_5obs")[5] == 9.0 - 1.0


def test_zscore_warms_up_and_ignores_constants(spark):
    df = X.with_zscore(long_frame(spark, {"a": [i + 1 for i in range(61)], "b": [7] * 61}))
    z = column(df, "zscore_60obs")
    assert z[:59] == [None] * 59
    assert z[59] == pytest.approx((60 - 30.5) / pstdev(range(1, 61)))
    assert column(df, "zscore_60obs", "b") == [None] * 61


def test_momentum_is_clipped_and_exact(spark):
    levels = [0.0]
    for i in range(280):
        levels.append(levels[-1] + (1 if i % 2 == 0 else 2))
    df = X.with_momentum(long_frame(spark, {"a": levels}))
    one, twenty = column(df, "momentum_autocorr_1_60obs"), column(df, "momentum_autocorr_20_120obs")
    assert one[:61] == [None] * 61 and set(one[61:]) == {0.0}
    assert twenty[:140] == [None] * 140
    assert all(v == pytest.approx(1.0) for v in twenty[140:])


def test_returns_compound_and_refuse_invalid_steps(spark):
    values = [1.01**i for i in range(30)]
    df = X.with_mean_returns(X.with_returns(long_frame(spark, {"a": values, "b": [*values[:15], 0.0, *values[16:]]}), (10, 25)), (10,))
    assert column(df, "return_geom_10obs_pct")[:10] == [None] * 10
    assert column(df, "return_geom_10obs_pct")[10] == pytest.approx(100 * (1.01**10 - 1))
    assert column(df, "return_geom_25obs_pct")[25] == pytest.approx(100 * (math.exp(25 * math.log(1.01)) - 1))
    assert column(df, "return_mean_10obs_pct")[10] == pytest.approx(1.0)
    b = column(df, "return_geom_10obs_pct", "b")
    assert all(v is None for v in b[15:26]) and b[26] is not None


def all_series(spark, n=61, last=0.0):
    return long_frame(spark, {s: [i + 1 + (last if i == n - 1 else 0) for i in range(n)] for s in (*X.VOLATILITY, *X.MACRO)})


def test_wide_frame_has_its_columns_and_values(spark):
    frame = X.assemble(X.long_features(all_series(spark)))
    assert frame.columns == X.WIDE_COLUMNS and len(frame.columns) == 166
    row = frame.orderBy(F.desc("timestamp_m1")).first()
    assert (row.vix_level, row.us_2y_delta_20obs, row.vix9d_vix_ratio, row.us_10y_minus_us_2y) == (61.0, 20.0, 1.0, 0.0)
    assert row.vix_zscore_60obs == pytest.approx(29.5 / pstdev(range(60)))


def test_later_rows_dont_change_earlier_ones(spark):
    a, b = (X.assemble(X.long_features(all_series(spark, last=x))).orderBy("timestamp_m1").collect() for x in (0.0, 1000.0))
    assert a[:-1] == b[:-1] and a[-1] != b[-1]


def test_families_join_to_the_same_frame(spark):
    long = X.long_features(long_frame(spark, {s: [k * 10 + i if (i + k) % 3 else None for i in range(30)] for k, s in enumerate((*X.VOLATILITY, *X.MACRO))}))
    joined = X.join_families(X.family(long, X.VOLATILITY), X.family(long, X.MACRO))
    assert joined.exceptAll(X.assemble(long)).isEmpty() and X.assemble(long).exceptAll(joined).isEmpty()


def test_nothing_is_filled_between_series(spark):
    long = X.long_features(long_frame(spark, {s: [1 if (i + k) % 2 else None for i in range(6)] for k, s in enumerate((*X.VOLATILITY, *X.MACRO))}))
    assert X.assemble(long).where("vix_level is not null and vix9d_level is not null").isEmpty()
    assert X.assemble(long).where("vix9d_vix_ratio is not null").isEmpty()


def test_nan_becomes_null_and_infinity_is_counted(spark):
    long = X.long_features(all_series(spark, 5)).withColumn("level", F.when(F.col("series_id") == "vix", float("nan")).when(F.col("series_id") == "move", float("inf")).otherwise(F.col("level")))
    frame = X.assemble(long)
    assert frame.where("vix_level is not null").isEmpty()
    assert X.infinite_cells(frame).first().cells == 5


def test_digests_are_those_of_the_bytes(spark):
    import hashlib
    import random
    import struct
    from datetime import UTC, datetime

    from pyspark.sql import functions as F

    from tideline.functions import scalars as S
    from tideline.operators import serving

    r = random.Random(8)
    some = [0.0, -0.0, 1.0, -1.5, 5e-324, -5e-324, 2.2250738585072009e-308, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308, 0.1, 1 / 3, 1e15, 123456789.0, 2.0**-1022, 2.0**1023]
    some += [x for x in (struct.unpack(">d", r.randbytes(8))[0] for _ in range(3000)) if x == x and abs(x) != float("inf")]
    df = spark.createDataFrame([(x,) for x in some], "x double")
    assert all(bytes.fromhex(h) == struct.pack(">d", x + 0.0) for x, h in df.select("x", S.double_hex(S.unsigned_zero(F.col("x")))).collect())
    assert [h for (h,) in spark.createDataFrame([(0,), (-1,), (-(2**63),)], "x long").select(S.long_hex(F.col("x"))).collect()] == ["0" * 16, "f" * 16, "8" + "0" * 15]
    rows = [(datetime(1960 + k % 90, 1, 1 + k % 28, 1, 2, 3, k), x, None if k % 3 else -x) for k, x in enumerate(some[:300])]
    frame = spark.createDataFrame(rows, f'{serving.KEY} timestamp, a double, `b"\u00e9` double')
    found = {row[0]: row[1] for row in serving.digests(frame).collect()}
    for at, a, b in rows:
        assert found[at] == hashlib.sha256(serving.row_bytes(at.replace(tzinfo=UTC), [("a", a), ('b"\u00e9', b)])).hexdigest()
    bare = frame.select(serving.KEY).limit(1)
    assert serving.digests(bare).first().row_sha256 == hashlib.sha256(serving.row_bytes(bare.first()[0].replace(tzinfo=UTC), [])).hexdigest()
    for bad in (float("nan"), float("inf"), float("-inf")):
        with pytest.raises(Exception, match="neither null nor finite"):
            serving.digests(spark.createDataFrame([(datetime(2024, 1, 1), bad)], f"{serving.KEY} timestamp, a double")).collect()
