"""The library's registered queries and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline import inputs as I
from tideline import registry
from tideline.functions import scalars as S
from tideline.operators import catalog as C
from tideline.operators import contract, diff, features, profile, quality, serving, silver
from tideline.plans import planner

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def _rounded(df: DataFrame, *kept: str) -> DataFrame:
    """Doubles as reports show them, so that both engines' results can be compared."""
    return df.select(*[S.edge(F.col(c)).alias(c) if t == "double" and c not in kept else F.col(c) for c, t in df.dtypes])


# --- SQL fragments -----------------------------------------------------------------------------------

_O = "(PARTITION BY series_id ORDER BY observation_date)"


def _w(n: int) -> str:
    return f"(PARTITION BY series_id ORDER BY observation_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _r(x: str) -> str:
    return f"round({x}, 6) + 0.0"


def _delta_sql(n: int) -> str:
    return f"value - lag(value, {n}) OVER {_O}"


def _zscore_sql(n: int = 60) -> str:
    w = _w(n)
    return f"CASE WHEN count(value) OVER {w} = {n} AND stddev_pop(value) OVER {w} > 0 THEN (value - avg(value) OVER {w}) / stddev_pop(value) OVER {w} END"


def _momentum_sql(h: int, n: int) -> str:
    w, x = _w(n), f"change_{h}"
    sd = f"(stddev_pop(change) OVER {w} * stddev_pop({x}) OVER {w})"
    return f"CASE WHEN count(change) OVER {w} = {n} AND count({x}) OVER {w} = {n} AND {sd} > 0 THEN greatest(covar_pop(change, {x}) OVER {w} / {sd}, 0.0) END"


def _return_sql(n: int) -> str:
    return f"CASE WHEN count(step) OVER {_w(n)} = {n} THEN 100 * (value / lag(value, {n}) OVER {_O} - 1) END"


_CHANGES = f"c1 AS (SELECT *, value - lag(value) OVER {_O} AS change, CASE WHEN value > 0 AND lag(value) OVER {_O} > 0 THEN value / lag(value) OVER {_O} - 1 END AS step FROM {{source}})"
_LAGS = f"c2 AS (SELECT *, lag(change, 1) OVER {_O} AS change_1, lag(change, 5) OVER {_O} AS change_5, lag(change, 20) OVER {_O} AS change_20 FROM c1)"


def _long_sql(source: str) -> str:
    """CTEs that end in `feat`, the long feature frame."""
    columns = (
        [f"{_delta_sql(n)} AS delta_{n}obs" for n in (1, 5, 20)]
        + [f"{_zscore_sql()} AS zscore_60obs"]
        + [f"{_momentum_sql(h, w)} AS momentum_autocorr_{h}_{w}obs" for h, w in features.MOMENTUM]
        + [f"{_return_sql(w)} AS return_geom_{w}obs_pct" for w in features.RETURNS]
    )
    return f"{_CHANGES.format(source=source)}, {_LAGS}, feat AS (SELECT series_id, observation_date, value AS level, {', '.join(columns)} FROM c2)"


def _wide_sql(columns: list[str]) -> str:
    """Wide columns from `feat`, each picked by series and feature, cross-series ones by their definition."""
    pick = lambda s, f: f"max(CASE WHEN series_id = '{s}' THEN {f} END)"
    out = []
    for c in columns:
        if c in features.RATIOS:
            a, b = (pick(s, "level") for s in features.RATIOS[c])
            e = f"CASE WHEN {b} > 0 THEN {a} / {b} END"
        elif c in features.SPREADS or c in features.SLOPES:
            a, b = (pick(s, "level") for s in (features.SPREADS | features.SLOPES)[c])
            e = f"{a} - {b}"
        else:
            s = max((x for x in registry.SERIES if c.startswith(x + "_")), key=len)
            e = pick(s, c[len(s) + 1 :])
        out.append(f"{_r(e)} AS {c}")
    return ", ".join(out)


# --- windows -----------------------------------------------------------------------------------------


@_query(f"WITH {I.LINE_SQL} SELECT * FROM s_line")
def daily_series(spark, sf_dir):
    return I.line_series(spark, sf_dir)


@_query(f"WITH {I.LINE_SQL} SELECT series_id, observation_date, value, " + ", ".join(f"{_r(_delta_sql(n))} AS delta_{n}obs" for n in (1, 5, 20)) + " FROM s_line")
def delta_lags(spark, sf_dir):
    return _rounded(features.with_deltas(I.line_series(spark, sf_dir)), "value")


@_query(f"WITH {I.LINE_SQL} SELECT series_id, observation_date, {_r('CASE WHEN count(value) OVER ' + _w(60) + ' = 60 THEN avg(value) OVER ' + _w(60) + ' END')} AS mean_60, {_r('CASE WHEN count(value) OVER ' + _w(60) + ' = 60 THEN stddev_pop(value) OVER ' + _w(60) + ' END')} AS deviation_60 FROM s_line")
def rolling_moments(spark, sf_dir):
    from tideline.functions import windows as W

    value = F.col("value")
    return _rounded(I.line_series(spark, sf_dir).select("series_id", "observation_date", W.rolling_mean(value, 60).alias("mean_60"), W.rolling_deviation(value, 60).alias("deviation_60")))


@_query(f"WITH {I.LINE_SQL} SELECT series_id, observation_date, value, {_r(_zscore_sql())} AS zscore_60obs FROM s_line")
def zscore_60(spark, sf_dir):
    return _rounded(features.with_zscore(I.line_series(spark, sf_dir)), "value")


@_query(
    f"WITH {I.LINE_SQL}, {_CHANGES.format(source='s_line')}, {_LAGS} SELECT series_id, observation_date, value, "
    + ", ".join(f"{_r(_momentum_sql(h, w))} AS momentum_autocorr_{h}_{w}obs" for h, w in features.MOMENTUM)
    + " FROM c2"
)
def momentum_autocorr(spark, sf_dir):
    return _rounded(features.with_momentum(I.line_series(spark, sf_dir)), "value")


@_query(f"WITH {I.LINE_SQL}, {_CHANGES.format(source='s_line')} SELECT series_id, observation_date, value, " + ", ".join(f"{_r(_return_sql(w))} AS return_geom_{w}obs_pct" for w in features.RETURNS) + " FROM c1")
def compound_return(spark, sf_dir):
    return _rounded(features.with_returns(I.line_series(spark, sf_dir)), "value")


@_query(
    f"WITH {I.ORDER_SQL}, {_CHANGES.format(source='s_order')} SELECT series_id, observation_date, value, "
    + ", ".join(_r(f"CASE WHEN count(step) OVER {_w(w)} = {w} THEN 100 * (pow(value / lag(value, {w}) OVER {_O}, {1.0 / w!r}) - 1) END") + f" AS return_mean_{w}obs_pct" for w in (10, 60))
    + " FROM c1"
)
def mean_return(spark, sf_dir):
    return _rounded(features.with_mean_returns(I.order_series(spark, sf_dir), (10, 60)), "value")


# --- wide assembly -----------------------------------------------------------------------------------

_CROSS = [*features.RATIOS, *features.SPREADS, *features.SLOPES]


@_query(f"WITH {I.ALL_SQL}, feat AS (SELECT series_id, observation_date, value AS level FROM s_all) SELECT observation_date, {_wide_sql(_CROSS)} FROM feat GROUP BY observation_date")
def safe_ratio_spread(spark, sf_dir):
    levels = I.all_series(spark, sf_dir).withColumnRenamed("value", "level")
    frame = features.with_cross_series(features.wide(levels, (*features.VOLATILITY, *features.MACRO), ("level",)).select("timestamp_m1", *[F.col(s).alias(f"{s}_level") for s in (*features.VOLATILITY, *features.MACRO)]))
    return _rounded(frame.select(F.to_date("timestamp_m1").alias("observation_date"), *_CROSS))


@_query(f"WITH {I.ALL_SQL}, {_long_sql('s_all')} SELECT observation_date, {_wide_sql(features.WIDE_COLUMNS[1:])} FROM feat GROUP BY observation_date")
def wide_gold(spark, sf_dir):
    frame = features.assemble(features.long_features(I.all_series(spark, sf_dir)))
    return _rounded(frame.withColumn("observation_date", F.to_date("timestamp_m1")).select("observation_date", *features.WIDE_COLUMNS[1:]))


_MACRO_COLUMNS = [*features.MACRO_BASE, *features.momentum_columns(features.MACRO), *features.return_columns(features.MACRO)]


@_query(f"WITH {I.ALL_SQL}, {_long_sql('s_all')} SELECT observation_date, {_wide_sql(_MACRO_COLUMNS)} FROM feat WHERE series_id IN ({', '.join(repr(s) for s in features.MACRO)}) GROUP BY observation_date")
def macro_family(spark, sf_dir):
    frame = features.family(features.long_features(I.all_series(spark, sf_dir)), features.MACRO)
    return _rounded(frame.withColumn("observation_date", F.to_date("timestamp_m1")).select("observation_date", *_MACRO_COLUMNS))


_VOLATILITY_COLUMNS = [*features.VOLATILITY_BASE, *features.momentum_columns(features.VOLATILITY), *features.return_columns(features.VOLATILITY)]


@_query(f"WITH {I.ALL_SQL}, {_long_sql('s_all')} SELECT observation_date, {_wide_sql(_VOLATILITY_COLUMNS)} FROM feat WHERE series_id IN ({', '.join(repr(s) for s in features.VOLATILITY)}) GROUP BY observation_date")
def volatility_family(spark, sf_dir):
    frame = features.family(features.long_features(I.all_series(spark, sf_dir)), features.VOLATILITY)
    return _rounded(frame.withColumn("observation_date", F.to_date("timestamp_m1")).select("observation_date", *_VOLATILITY_COLUMNS))


@_query(
    f"WITH {I.LINE_SQL}, {I.ORDER_SQL}, a AS (SELECT observation_date, sum(value) AS quantity FROM s_line GROUP BY 1), b AS (SELECT observation_date, round(sum(value), 2) AS price FROM s_order GROUP BY 1) "
    "SELECT observation_date, quantity, price FROM a FULL JOIN b USING (observation_date)"
)
def outer_join_families(spark, sf_dir):
    a = I.line_series(spark, sf_dir).groupBy("observation_date").agg(F.sum("value").alias("quantity"))
    b = I.order_series(spark, sf_dir).groupBy("observation_date").agg(F.round(F.sum("value"), 2).alias("price"))
    return a.join(b, "observation_date", "full")


# --- comparing and merging ---------------------------------------------------------------------------

_EXISTING = "ex AS (SELECT * FROM orders WHERE o_orderkey % 10 <> 0)"
_INCOMING = "inc AS (SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM orders WHERE o_orderkey % 7 <> 0)"
_KEY = ["o_orderkey"]
_CHANGE = "CASE WHEN ex.o_orderkey IS NULL THEN 'insert' WHEN " + " AND ".join(f"inc.{c} IS NOT DISTINCT FROM ex.{c}" for c in ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")) + " THEN 'unchanged' ELSE 'revision' END"


def _sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """An existing and an incoming table of orders: some only in one of them, some revised."""
    orders = I.read(spark, sf_dir, "orders")
    raised = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return orders.where("o_orderkey % 10 <> 0"), orders.where("o_orderkey % 7 <> 0").withColumn("o_totalprice", raised)


@_query(f"WITH {_EXISTING}, {_INCOMING} SELECT inc.*, {_CHANGE} AS change_type FROM inc LEFT JOIN ex USING (o_orderkey)")
def diff_classify(spark, sf_dir):
    return diff.classify(*_sides(spark, sf_dir), _KEY)


@_query(f"WITH {_EXISTING}, {_INCOMING}, new AS (SELECT inc.* FROM inc LEFT JOIN ex USING (o_orderkey) WHERE {_CHANGE} <> 'unchanged') SELECT * FROM ex WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new) UNION ALL SELECT * FROM new")
def upsert_merge(spark, sf_dir):
    return diff.merge(*_sides(spark, sf_dir), _KEY)


@_query(f"WITH {_EXISTING}, {_INCOMING} SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month FROM (SELECT inc.* FROM inc LEFT JOIN ex USING (o_orderkey) WHERE {_CHANGE} <> 'unchanged') GROUP BY ALL")
def affected_months(spark, sf_dir):
    return diff.affected_months(diff.changed(diff.classify(*_sides(spark, sf_dir), _KEY)), "o_orderdate")


@_query(
    f"WITH {_EXISTING}, {_INCOMING} SELECT inc.o_orderkey, inc.o_custkey, inc.o_totalprice, CASE WHEN ex.o_orderkey IS NOT NULL AND inc.o_totalprice IS NOT DISTINCT FROM ex.o_totalprice AND inc.o_custkey IS NOT DISTINCT FROM ex.o_custkey "
    "THEN 'old' ELSE 'new' END AS fetched FROM inc LEFT JOIN ex USING (o_orderkey)"
)
def stable_fetched_at(spark, sf_dir):
    old, new = (df.select("o_orderkey", "o_custkey", "o_totalprice", F.lit(tag).alias("fetched")) for df, tag in zip(_sides(spark, sf_dir), ("old", "new"), strict=True))
    return diff.keep_when_same(old, new, _KEY, "fetched")


def _digested(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", F.md5(F.concat_ws("|", F.col("o_custkey").cast("string"), S.edge(F.col("o_totalprice"), 2).cast("decimal(20,2)").cast("string"), "o_orderstatus")).alias("digest"))


_DIGEST = "md5(concat_ws('|', o_custkey::VARCHAR, o_totalprice::DECIMAL(20,2)::VARCHAR, o_orderstatus)) AS digest"
_OPS = (
    f"{_EXISTING}, {_INCOMING}, t AS (SELECT o_orderkey, {_DIGEST} FROM ex), s AS (SELECT o_orderkey, {_DIGEST} FROM inc), "
    "ops AS (SELECT o_orderkey, CASE WHEN t.digest IS NULL THEN 'insert' WHEN s.digest IS NULL THEN 'delete' WHEN s.digest = t.digest THEN 'unchanged' ELSE 'update' END AS op FROM s FULL JOIN t USING (o_orderkey))"
)


@_query(f"WITH {_OPS} SELECT * FROM ops")
def delta_plan(spark, sf_dir):
    target, source = map(_digested, _sides(spark, sf_dir))
    return diff.delta(source, target, _KEY, "digest")


@_query(f"WITH {_OPS} SELECT count(*) FILTER (op = 'insert') AS inserted, count(*) FILTER (op = 'update') AS updated, count(*) FILTER (op = 'delete') AS deleted, count(*) FILTER (op = 'unchanged') AS unchanged FROM ops")
def delta_counters(spark, sf_dir):
    return diff.delta_counts(delta_plan(spark, sf_dir))


@_query(f"WITH {_INCOMING} SELECT o_orderkey, {_DIGEST} FROM inc")
def replica_after_delta(spark, sf_dir):
    target, source = map(_digested, _sides(spark, sf_dir))
    return diff.apply_delta(source, target, diff.delta(source, target, _KEY, "digest"), _KEY)


@_query(f"WITH {_OPS} SELECT o_orderkey, CASE op WHEN 'insert' THEN 'only_left' WHEN 'delete' THEN 'only_right' ELSE 'different' END AS side FROM ops WHERE op <> 'unchanged'")
def digest_equality(spark, sf_dir):
    target, source = map(_digested, _sides(spark, sf_dir))
    return diff.difference(source, target, _KEY)


@_query(f"WITH {_EXISTING}, {_INCOMING} SELECT o_orderkey FROM ex EXCEPT SELECT o_orderkey FROM inc")
def deletes_only(spark, sf_dir):
    target, source = _sides(spark, sf_dir)
    return diff.without(target, source, _KEY)


@_query(f"WITH {_EXISTING}, {_INCOMING} SELECT o_orderkey, 2::BIGINT AS n FROM (SELECT o_orderkey FROM ex INTERSECT SELECT o_orderkey FROM inc)")
def set_disjoint(spark, sf_dir):
    return diff.shared_keys(_sides(spark, sf_dir), _KEY)


# --- filters, checks and profiles --------------------------------------------------------------------

_BAR_OK = "open >= 0 AND high >= 0 AND low >= 0 AND close >= 0 AND high >= low AND high >= greatest(open, close) AND low <= least(open, close)"


@_query(f"WITH {I.BARS_SQL}, odd AS (SELECT * REPLACE (CASE WHEN day(observation_date) % 7 = 0 THEN low - 1000 ELSE high END AS high) FROM bars) SELECT * FROM odd WHERE {_BAR_OK}")
def ohlc_valid(spark, sf_dir):
    bars = I.event_bars(spark, sf_dir)
    odd = bars.withColumn("high", F.when(F.day("observation_date") % 7 == 0, F.col("low") - 1000).otherwise(F.col("high")))
    return odd.where(S.valid_bar(*[F.col(c) for c in ("open", "high", "low", "close")]))


@_query(f"WITH {I.BARS_SQL} SELECT observation_date, series_id, close AS value, open, high, low, close, 'units' AS unit, 'events' AS provider, 'ev' AS source_id FROM bars")
def silver_ohlc(spark, sf_dir):
    bars = I.event_bars(spark, sf_dir).select("*", F.lit("events").alias("provider"), F.lit("ev").alias("source_id"), F.lit(None).cast("timestamp").alias("fetched_at_utc"))
    return silver.canonical(bars, "ohlc", "units").drop("fetched_at_utc")


@_query(f"WITH {I.LINE_SQL} SELECT observation_date, series_id, value, NULL::DOUBLE AS open, NULL::DOUBLE AS high, NULL::DOUBLE AS low, NULL::DOUBLE AS close, 'units' AS unit, 'lines' AS provider, 'li' AS source_id FROM s_line")
def silver_scalar(spark, sf_dir):
    rows = I.line_series(spark, sf_dir).select("*", F.lit("lines").alias("provider"), F.lit("li").alias("source_id"), F.lit(None).cast("timestamp").alias("fetched_at_utc"))
    return silver.canonical(rows, "scalar", "units").drop("fetched_at_utc")


@_query(f"WITH {I.ORDER_SQL} SELECT * FROM s_order WHERE observation_date BETWEEN DATE '1996-03-01' AND DATE '1996-09-30'")
def window_filter(spark, sf_dir):
    return I.order_series(spark, sf_dir).where(planner.in_window(F.col("observation_date"), date(1996, 3, 1), date(1996, 9, 30)))


@_query(f"WITH {I.ORDER_SQL} SELECT series_id, count(*) AS violations FROM s_order WHERE observation_date NOT BETWEEN DATE '1996-03-01' AND DATE '1996-09-30' GROUP BY 1")
def window_violations(spark, sf_dir):
    outside = ~planner.in_window(F.col("observation_date"), date(1996, 3, 1), date(1996, 9, 30))
    return I.order_series(spark, sf_dir).where(outside).groupBy("series_id").agg(F.count("*").alias("violations"))


@_query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING n > 1")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(I.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query("SELECT count(*) AS duplicate_keys, coalesce(sum(n), 0)::BIGINT AS duplicate_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def duplicate_members(spark, sf_dir):
    return quality.duplicate_members(I.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query(f"WITH {I.LINE_SQL} SELECT series_id, min(observation_date) AS minimum, max(observation_date) AS maximum FROM s_line GROUP BY 1")
def bounds(spark, sf_dir):
    return profile.bounds(I.line_series(spark, sf_dir), by=["series_id"])


@_query(
    "WITH checks AS (SELECT count(*) FILTER (series_id IS NULL) AS a, count(*) FILTER (observation_date IS NULL) AS b, count(*) FILTER (value IS NULL) AS c FROM (SELECT l_returnflag AS series_id, l_shipdate::DATE AS observation_date, l_quantity AS value FROM lineitem)), "
    "d AS (SELECT coalesce(sum(n), 0)::BIGINT AS d FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag, l_shipdate::DATE HAVING count(*) > 1)) "
    "SELECT 'series_id_null' AS \"check\", a AS violations FROM checks UNION ALL SELECT 'observation_date_null', b FROM checks UNION ALL SELECT 'value_not_finite', c FROM checks UNION ALL SELECT 'duplicate_key', d FROM d"
)
def quality_report(spark, sf_dir):
    rows = I.read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("series_id"), F.to_date("l_shipdate").alias("observation_date"), F.col("l_quantity").alias("value"))
    return quality.silver_checks(rows)


@_query("SELECT 'o_custkey' AS column_name, count(*) FILTER (o_custkey IS NULL) AS nulls FROM o UNION ALL SELECT 'c_name', count(*) FILTER (c_name IS NULL) FROM o".replace("FROM o", "FROM (SELECT * FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey)"))
def null_counts(spark, sf_dir):
    joined = I.read(spark, sf_dir, "customer").join(I.read(spark, sf_dir, "orders").select("o_custkey").distinct(), F.col("c_custkey") == F.col("o_custkey"), "left")
    return quality.null_counts(joined, ["o_custkey", "c_name"])


_INVENTORY_IDS = ", ".join(f"('{s.series_id}', '{s.provider}')" for s in registry.SERIES.values())


@_query(
    f"WITH {I.ALL_SQL}, r(series_id, provider) AS (VALUES {_INVENTORY_IDS}), part AS (SELECT * FROM s_all WHERE series_id NOT IN ('vix', 'estr') UNION ALL SELECT * FROM s_all WHERE series_id = 'move') "
    "SELECT r.series_id, r.provider, min(observation_date) AS min_observation_date, max(observation_date) AS max_observation_date, count(observation_date) AS row_count, "
    "coalesce(sum(CASE WHEN n > 1 THEN 1 END), 0)::BIGINT AS duplicate_key_count, 0::BIGINT AS file_count "
    "FROM r LEFT JOIN (SELECT *, count(*) OVER (PARTITION BY series_id, observation_date) AS n FROM part) s USING (series_id) GROUP BY ALL"
)
def inventory(spark, sf_dir):
    every = I.all_series(spark, sf_dir)
    some = every.where("series_id not in ('vix', 'estr')").unionByName(every.where("series_id = 'move'"))
    return profile.inventory(registry.registry_frame(spark), some)


_COVERED = ["vix_zscore_60obs", "vix_return_geom_240obs_pct", "us_10y_minus_us_2y"]


@_query(
    f"WITH {I.ALL_SQL}, {_long_sql('s_all')}, g AS (SELECT observation_date, {_wide_sql(_COVERED)} FROM feat GROUP BY observation_date) "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, {_r(f'count({c})::DOUBLE / greatest(count(*), 1)')} AS coverage FROM g" for c in _COVERED)
)
def coverage(spark, sf_dir):
    return _rounded(profile.coverage(features.assemble(features.long_features(I.all_series(spark, sf_dir))), _COVERED))


@_query(f"WITH {I.LINE_SQL} SELECT series_id, count(value) AS n, {_r('avg(value)')} AS mean, min(value) AS minimum, max(value) AS maximum, least(30, greatest(5, floor(sqrt(count(value)))))::BIGINT AS bins FROM s_line GROUP BY 1")
def profile_stats(spark, sf_dir):
    return _rounded(profile.statistics(I.line_series(spark, sf_dir), "series_id"), "minimum", "maximum")


@_query(
    f"WITH {I.LINE_SQL}, st AS (SELECT series_id, min(value) AS lo, max(value) AS hi, least(30, greatest(5, floor(sqrt(count(value)))))::BIGINT AS bins FROM s_line GROUP BY 1) "
    "SELECT series_id, CASE WHEN hi = lo THEN 1 ELSE least(floor((value - lo) / ((hi - lo) / bins)) + 1, bins) END::BIGINT AS bin, count(*) AS n FROM s_line JOIN st USING (series_id) GROUP BY 1, 2"
)
def profile_histogram(spark, sf_dir):
    return profile.histogram(I.line_series(spark, sf_dir), "series_id")


@_query(f"WITH {I.LINE_SQL}, z AS (SELECT series_id, observation_date, {_zscore_sql()} AS value FROM s_line), f AS (SELECT series_id, min(observation_date) FILTER (value IS NOT NULL) AS first_day FROM z GROUP BY 1) SELECT series_id, count(*) FILTER (first_day IS NULL OR observation_date < first_day) AS rows_before_value FROM z JOIN f USING (series_id) GROUP BY 1")
def leading_gap(spark, sf_dir):
    return profile.leading_gap(features.with_zscore(I.line_series(spark, sf_dir)).select("series_id", "observation_date", F.col("zscore_60obs").alias("value")))


_LINE_SHA = "sha256(concat_ws(chr(31), observation_date::VARCHAR, value::BIGINT::VARCHAR))"


@_query(
    f"WITH {I.LINE_SQL}, m AS (SELECT series_id, strftime(observation_date, '%Y%m') AS month, count(*) AS n, min(observation_date) AS lo, max(observation_date) AS hi, sha256(string_agg({_LINE_SHA}, chr(10) ORDER BY observation_date)) AS d FROM s_line GROUP BY 1, 2) "
    "SELECT series_id, sum(n)::BIGINT AS row_count, min(lo) AS min_observation_date, max(hi) AS max_observation_date, sha256(string_agg(d, chr(10) ORDER BY month)) AS sha256 FROM m GROUP BY 1"
)
def input_signature(spark, sf_dir):
    return profile.signature(I.line_series(spark, sf_dir).withColumn("value", F.col("value").cast("long")))


@_query(f"WITH {I.LINE_SQL} SELECT * FROM (SELECT *, lag(observation_date) OVER {_O} AS b FROM (SELECT * FROM s_line UNION ALL SELECT * FROM s_line WHERE day(observation_date) = 1)) WHERE observation_date <= b".replace("SELECT * FROM (SELECT *, lag", "SELECT series_id, observation_date, value FROM (SELECT *, lag"))
def not_increasing(spark, sf_dir):
    rows = I.line_series(spark, sf_dir)
    return quality.not_increasing(rows.unionByName(rows.where(F.day("observation_date") == 1)), "observation_date", ["series_id"])


@_query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    return I.read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


_TEXTS = "CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN '.' WHEN 3 THEN NULL WHEN 4 THEN 'bad' ELSE strftime(o_orderdate, '%d.%m.%Y') END"


@_query(f"WITH x AS (SELECT o_orderkey, o_orderdate::DATE AS d, o_orderkey % 6 AS k, {_TEXTS} AS t FROM orders) SELECT o_orderkey, CASE WHEN k IN (0, 1, 5) THEN d END AS day, k IN (2, 3) AS missing FROM x")
def date_parsing(spark, sf_dir):
    k, d = F.col("o_orderkey") % 6, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(d, "MM/dd/yyyy")).when(k == 1, F.date_format(d, "yyyy-MM-dd")).when(k == 2, ".").when(k == 3, F.lit(None)).when(k == 4, "bad").otherwise(F.date_format(d, "dd.MM.yyyy"))
    rows = I.read(spark, sf_dir, "orders").select("o_orderkey", text.alias("t"))
    return rows.select("o_orderkey", S.first_date(F.col("t"), ("MM/dd/yyyy", "yyyy-MM-dd", "dd.MM.yyyy")).alias("day"), S.missing(F.col("t")).alias("missing"))


@_query("SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*[^?#]*)', 1) AS path FROM pages")
def sanitized_urls(spark, sf_dir):
    return I.read(spark, sf_dir, "pages").select("page_id", S.path_only(F.col("url")).alias("path"))


# --- planning ----------------------------------------------------------------------------------------

_CAPABILITY = ", ".join(f"('{s.series_id}', '{s.capability}')" for s in registry.SERIES.values())


@_query(
    f"WITH {I.ALL_SQL}, r(series_id, capability) AS (VALUES {_CAPABILITY}), b AS (SELECT series_id, max(observation_date) AS newest FROM s_all WHERE series_id NOT IN ('vix', 'estr') GROUP BY 1) "
    "SELECT series_id, CASE WHEN newest IS NULL THEN 'bootstrap' ELSE 'update' END AS mode, CASE WHEN capability = 'date_range' THEN newest - 7 END AS request_start, DATE '2030-01-01' AS request_end, newest IS NULL AS maximum_history, newest - 7 AS filter_start, CASE WHEN newest IS NOT NULL THEN DATE '2030-01-01' END AS filter_end FROM r LEFT JOIN b USING (series_id)"
)
def plan_windows(spark, sf_dir):
    known = profile.bounds(I.all_series(spark, sf_dir).where("series_id not in ('vix', 'estr')"), by=["series_id"])
    return planner.plan_frame(registry.registry_frame(spark), known, date(2030, 1, 1))


# --- catalog -----------------------------------------------------------------------------------------

_CATALOG = (
    "cat AS (SELECT 'd' AS dataset_id, lpad(o_orderkey::VARCHAR, 12, '0') AS build_id, CASE o_orderkey % 5 WHEN 0 THEN 'building' WHEN 1 THEN 'failed' ELSE 'complete' END AS status, o_orderkey = 7 AS current, "
    "o_orderdate AS started, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + INTERVAL 1 HOUR END AS completed, 3 + o_orderkey % 2 AS sv, 2 + o_orderkey % 2 AS fv, CASE WHEN o_orderkey % 11 = 0 AND o_orderkey % 5 > 1 THEN o_orderdate END AS pruned, "
    "CASE WHEN o_orderkey % 5 > 1 AND o_orderkey % 11 <> 0 THEN 'p' || o_orderkey END AS path FROM orders)"
)
_USABLE = "status = 'complete' AND pruned IS NULL AND path IS NOT NULL"


def _catalog(spark, sf_dir) -> DataFrame:
    """Orders as if each were a snapshot."""
    k, at = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    complete = k % 5 > 1
    path = F.when(complete & (k % 11 != 0), F.concat(F.lit("p"), k.cast("string")))
    return I.read(spark, sf_dir, "orders").select(
        F.lit("d").alias("dataset_id"), F.lpad(k.cast("string"), 12, "0").alias("build_id"), F.when(k % 5 == 0, "building").when(k % 5 == 1, "failed").otherwise("complete").alias("status"),
        (k == 7).alias("current"), at.alias("started_at_utc"), F.when(k % 5 != 0, at + F.expr("INTERVAL 1 HOUR")).alias("completed_at_utc"), (3 + k % 2).alias("schema_version"), (2 + k % 2).alias("feature_version"),
        F.lit(None).cast("timestamp").alias("min_timestamp"), F.lit(None).cast("timestamp").alias("max_timestamp"), F.lit(None).cast("long").alias("row_count"),
        path.alias("data_path"), path.alias("build_manifest_path"), path.alias("plot_path"), F.when(complete & (k % 11 == 0), at).alias("pruned_at_utc"),
    )


@_query(f"WITH {_CATALOG} SELECT build_id, sv AS schema_version FROM cat WHERE current AND {_USABLE} AND sv = 4 AND fv = 3")
def resolve_strict(spark, sf_dir):
    return C.resolve_strict(_catalog(spark, sf_dir), 4, 3).select("build_id", "schema_version")


@_query(f"WITH {_CATALOG} SELECT build_id, sv AS schema_version FROM cat WHERE {_USABLE} AND sv = 3 AND fv = 2 ORDER BY completed DESC, build_id DESC LIMIT 1")
def resolve_latest(spark, sf_dir):
    return C.resolve_latest(_catalog(spark, sf_dir), 3, 2).select("build_id", "schema_version")


@_query(f"WITH {_CATALOG}, h AS (SELECT *, count(*) OVER (PARTITION BY sv, fv) - 1000 AS ov FROM cat WHERE {_USABLE}), k AS (SELECT *, row_number() OVER (PARTITION BY sv, fv ORDER BY completed, build_id) AS rn FROM h WHERE NOT current) SELECT build_id FROM k WHERE rn <= ov")
def retention_marks(spark, sf_dir):
    return C.excess(_catalog(spark, sf_dir), 1000).select("build_id")


@_query(f"WITH {_CATALOG}, h AS (SELECT *, count(*) OVER (PARTITION BY sv, fv) - 1000 AS ov FROM cat WHERE {_USABLE}), k AS (SELECT *, row_number() OVER (PARTITION BY sv, fv ORDER BY completed, build_id) AS rn FROM h WHERE NOT current) SELECT build_id, path AS data_path, pruned IS NOT NULL AS is_pruned FROM cat WHERE build_id NOT IN (SELECT build_id FROM k WHERE rn <= ov) UNION ALL SELECT build_id, NULL, true FROM k WHERE rn <= ov")
def retention_marked(spark, sf_dir):
    from datetime import UTC, datetime

    return C.mark_pruned(_catalog(spark, sf_dir), datetime(2030, 1, 1, tzinfo=UTC), 1000).select("build_id", "data_path", F.col("pruned_at_utc").isNotNull().alias("is_pruned"))


@_query(f"WITH {_CATALOG} SELECT build_id, CASE WHEN build_id = '000000000010' THEN 'complete' ELSE status END AS status, build_id = '000000000010' AS current, CASE WHEN build_id = '000000000010' THEN 'new' ELSE path END AS data_path FROM cat")
def promote_rewrite(spark, sf_dir):
    return C.promote(_catalog(spark, sf_dir), "000000000010", {c: "new" for c in C.PATHS}).select("build_id", "status", "current", "data_path")


@_query(f"WITH {_CATALOG} SELECT build_id, CASE status WHEN 'building' THEN 'failed' ELSE status END AS status, status = 'building' OR completed IS NOT NULL AS is_finished FROM cat")
def stale_to_failed(spark, sf_dir):
    from datetime import UTC, datetime

    return C.fail_stale(_catalog(spark, sf_dir), datetime(2030, 1, 1, tzinfo=UTC)).select("build_id", "status", F.col("completed_at_utc").isNotNull().alias("is_finished"))


@_query(
    f"WITH {_CATALOG}, x AS (SELECT *, sv AS s FROM cat) SELECT 'unknown_status' AS \"check\", 0::BIGINT AS violations UNION ALL SELECT 'negative_count', 0 UNION ALL SELECT 'bounds_out_of_order', 0 UNION ALL SELECT 'completed_before_started', 0 UNION ALL SELECT 'paths_incomplete', 0 "
    f"UNION ALL SELECT 'current_not_usable', count(*) FILTER (current AND NOT ({_USABLE})) FROM x UNION ALL SELECT 'complete_without_time', 0 UNION ALL SELECT 'several_current', 0 UNION ALL SELECT 'duplicate_build_id', 0"
)
def catalog_rules(spark, sf_dir):
    return C.broken_rules(_catalog(spark, sf_dir))


_BROKEN = (
    "SELECT CASE WHEN k % 17 = 0 THEN 'lost' ELSE status END AS status, CASE WHEN k % 43 = 0 THEN k + 1 ELSE k END AS b, CASE WHEN k % 19 = 0 THEN -1 ELSE k END AS n, started, CASE WHEN k % 23 = 0 THEN started - INTERVAL 1 DAY ELSE started END AS high, "
    "CASE WHEN k % 41 = 0 THEN NULL WHEN k % 29 = 0 THEN started - INTERVAL 1 HOUR ELSE completed END AS completed, pruned, path, CASE WHEN k % 31 = 0 THEN NULL ELSE path END AS plot, k % 37 = 0 AS current FROM (SELECT *, build_id::BIGINT AS k FROM cat)"
)


@_query(
    f"WITH {_CATALOG}, x AS ({_BROKEN}) SELECT unnest(['unknown_status', 'negative_count', 'bounds_out_of_order', 'completed_before_started', 'paths_incomplete', 'current_not_usable', 'complete_without_time', 'several_current', 'duplicate_build_id']) AS \"check\", "
    "unnest([count(*) FILTER (status NOT IN ('building', 'complete', 'failed')), count(*) FILTER (n < 0), count(*) FILTER (high < started), count(*) FILTER (completed < started), count(*) FILTER ((path IS NULL) <> (plot IS NULL)), "
    "count(*) FILTER (current AND NOT (status = 'complete' AND completed IS NOT NULL AND pruned IS NULL AND path IS NOT NULL AND plot IS NOT NULL)), count(*) FILTER (status = 'complete' AND completed IS NULL), greatest(count(*) FILTER (current) - 1, 0), count(*) FILTER (several > 1)]) AS violations FROM (SELECT *, count(*) OVER (PARTITION BY b) AS several FROM x)"
)
def catalog_rules_broken(spark, sf_dir):
    """The rules over a catalog of which some rows break each."""
    k = F.col("build_id").cast("long")
    at = F.col("started_at_utc")
    broken = _catalog(spark, sf_dir).withColumns({
        "status": F.when(k % 17 == 0, "lost").otherwise(F.col("status")),
        "row_count": F.when(k % 19 == 0, F.lit(-1)).otherwise(k).cast("long"),
        "min_timestamp": at,
        "max_timestamp": F.when(k % 23 == 0, at - F.expr("INTERVAL 1 DAY")).otherwise(at),
        "completed_at_utc": F.when(k % 41 == 0, F.lit(None).cast("timestamp")).when(k % 29 == 0, at - F.expr("INTERVAL 1 HOUR")).otherwise(F.col("completed_at_utc")),
        "plot_path": F.when(k % 31 != 0, F.col("plot_path")),
        "current": k % 37 == 0,
        "build_id": F.lpad(F.when(k % 43 == 0, k + 1).otherwise(k).cast("string"), 12, "0"),
    })
    return C.broken_rules(broken)


@_query(f"WITH {_CATALOG} SELECT sv AS schema_version, fv AS feature_version, count(*) AS n, greatest(count(*) - 5, 0)::BIGINT AS excess FROM cat WHERE {_USABLE} GROUP BY 1, 2")
def builds_by_version(spark, sf_dir):
    held = _catalog(spark, sf_dir).where(C.selectable())
    return held.groupBy("schema_version", "feature_version").agg(F.count("*").alias("n"), F.greatest(F.count("*") - 5, F.lit(0)).cast("long").alias("excess"))


@_query(f"WITH {_CATALOG} SELECT build_id, (sv = 4 AND fv = 3) OR (sv = 3 AND fv = 2) AS may_move FROM cat")
def version_upgrades(spark, sf_dir):
    return _catalog(spark, sf_dir).select("build_id", serving.upgradable(F.col("schema_version"), F.col("feature_version"), 4, 3).alias("may_move"))


@_query("SELECT count(*) AS row_count, min(o_orderdate) AS min_timestamp, max(o_orderdate) AS max_timestamp FROM orders")
def replica_summary(spark, sf_dir):
    return serving.summary(I.read(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "timestamp_m1"))


def _hex_of(x: str) -> str:
    """DuckDB's SQL for the 16 digits of a double's bits, from its exact hexadecimal text."""
    text, fraction = f"printf('%a', abs({x}))", f"split_part(split_part(printf('%a', abs({x})), 'p', 1), '.', 2)"
    exponent = f"(CASE WHEN {text} LIKE '0x1%' THEN split_part({text}, 'p', 2)::INT + 1023 ELSE 0 END + CASE WHEN {x} < 0 THEN 2048 ELSE 0 END)"
    return f"(format('{{:03x}}', {exponent}) || rpad({fraction}, 13, '0'))"


_FRAMED = lambda name, tag: name.encode().hex() + "00" + tag.encode().hex()
_ROW = f"sha256(unhex('{S.DIGEST_PREFIX.hex()}{_FRAMED('timestamp_m1', 'T')}' || format('{{:016x}}', epoch_us(ts)) || '{b'value'.hex()}00' || CASE WHEN value IS NULL THEN '4e' ELSE '46' || {_hex_of('value')} END))"


@_query(f"SELECT event_id, {_ROW} AS row_sha256 FROM events")
def row_digests(spark, sf_dir):
    rows = I.read(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    return rows.select("event_id", S.row_digest(F.col("at"), ["value"]).alias("row_sha256"))


#: Doubles of all kinds out of a balance: itself, tiny ones down to below the least normal number, and huge ones.
_KINDS = {"bits": "c_acctbal", "small_bits": "c_acctbal * 1e-300 * 1e-12", "huge_bits": "c_acctbal * 1e300"}


@_query(f"SELECT c_custkey, {', '.join(f'{_hex_of(f"({x})")} AS {name}' for name, x in _KINDS.items())} FROM (SELECT c_custkey, c_acctbal::DOUBLE AS c_acctbal FROM customer)".replace("1e-300", "1e-300::DOUBLE").replace("1e-12", "1e-12::DOUBLE").replace("1e300", "1e300::DOUBLE"))
def double_bits(spark, sf_dir):
    balance = F.col("c_acctbal").cast("double")
    kinds = {"bits": balance, "small_bits": balance * F.lit(1e-300) * F.lit(1e-12), "huge_bits": balance * F.lit(1e300)}
    return I.read(spark, sf_dir, "customer").select("c_custkey", *[S.double_hex(S.unsigned_zero(x)).alias(name) for name, x in kinds.items()])


@_query(
    """WITH attributes AS (SELECT c_nationkey AS attrelid, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS attnum, c_name AS attname FROM customer),
lists AS (SELECT s_name, s_nationkey, CASE WHEN s_suppkey % 3 = 0 THEN 'p' ELSE 'u' END AS contype, [s_suppkey % 3 + 8, s_suppkey % 4 + 1, s_suppkey % 3 + 5] AS conkey FROM supplier),
keys AS (SELECT s_name, s_nationkey, contype, unnest(conkey) AS attnum, generate_subscripts(conkey, 1) AS ordinal FROM lists)
SELECT r_name AS table_schema, n_name AS table_name, s_name AS key_name, contype AS key_type, array_to_string(list(attname ORDER BY ordinal), ',') AS key_columns
FROM keys JOIN attributes ON attrelid = s_nationkey AND attributes.attnum = keys.attnum JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL"""
)
def key_columns(spark, sf_dir):
    """A database's catalog made of nations (tables of regions), their customers (columns) and their suppliers (keys)."""
    customers, suppliers, nations, regions = (I.read(spark, sf_dir, t) for t in ("customer", "supplier", "nation", "region"))
    place = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))
    attributes = customers.select(F.col("c_nationkey").alias("attrelid"), place.alias("attnum"), F.col("c_name").alias("attname"))
    n = F.col("s_suppkey")
    constraints = suppliers.select(F.col("s_name").alias("conname"), F.col("s_nationkey").alias("conrelid"), F.when(n % 3 == 0, "p").otherwise("u").alias("contype"), F.array(*[x.cast("int") for x in (n % 3 + 8, n % 4 + 1, n % 3 + 5)]).alias("conkey"))
    classes = nations.select(F.col("n_nationkey").alias("oid"), F.col("n_name").alias("relname"), F.col("n_regionkey").alias("relnamespace"))
    found = contract.key_columns(constraints, classes, regions.select(F.col("r_regionkey").alias("oid"), F.col("r_name").alias("nspname")), attributes)
    return found.select("table_schema", "table_name", "key_name", "key_type", F.array_join("columns", ",").alias("key_columns"))


_LINES = "SELECT l_orderkey AS o, l_linenumber AS l, min(l_returnflag) AS low, max(l_returnflag) AS high, min(l_partkey) % 2 = 0 AS nullable FROM lineitem GROUP BY 1, 2"


@_query(
    f"""WITH x AS ({_LINES}),
w AS (SELECT o, 'c' || l AS c, row_number() OVER (PARTITION BY o ORDER BY l) AS p, low || CASE WHEN nullable THEN '' ELSE ' not null' END AS t FROM x WHERE o % 13 > 0 AND (o + l) % 9 > 0),
f AS (SELECT o, 'c' || l AS c, row_number() OVER (PARTITION BY o ORDER BY l) AS p, CASE WHEN o % 5 = 0 THEN high ELSE low END || CASE WHEN nullable THEN '' ELSE ' not null' END AS t FROM x WHERE o % 11 > 0 AND (o + l) % 7 > 0),
tw AS (SELECT DISTINCT o FROM w), tf AS (SELECT DISTINCT o FROM f), both_ AS (SELECT o FROM tw JOIN tf USING (o)),
wk AS (SELECT o, string_agg(c, ',' ORDER BY p) AS k FROM w WHERE p <= 2 AND o % 8 > 0 GROUP BY o),
fk AS (SELECT o, CASE WHEN o % 4 = 0 THEN string_agg(c, ',' ORDER BY p DESC) ELSE string_agg(c, ',' ORDER BY p) END AS k FROM f WHERE p <= 2 AND o % 6 > 0 GROUP BY o),
joined AS (SELECT coalesce(w.o, f.o) AS o, coalesce(w.c, f.c) AS c, w.p AS wp, f.p AS fp, w.t AS wt, f.t AS ft FROM w FULL JOIN f ON w.o = f.o AND w.c = f.c),
found AS (
  SELECT coalesce(tw.o, tf.o) AS o, CASE WHEN tf.o IS NULL THEN 'missing_table' WHEN tw.o IS NULL THEN 'extra_table' END AS violation, 'o' || coalesce(tw.o, tf.o) AS item, NULL AS wanted, NULL AS found FROM tw FULL JOIN tf ON tw.o = tf.o
  UNION ALL SELECT o, CASE WHEN fp IS NULL THEN 'missing_column' WHEN wp IS NULL THEN 'extra_column' END, c, wt, ft FROM joined WHERE o IN (FROM both_)
  UNION ALL SELECT o, 'moved_column', c, wp::VARCHAR, fp::VARCHAR FROM joined WHERE o IN (FROM both_) AND wp <> fp
  UNION ALL SELECT o, 'retyped_column', c, wt, ft FROM joined WHERE o IN (FROM both_) AND wt <> ft
  UNION ALL SELECT coalesce(wk.o, fk.o), CASE WHEN fk.o IS NULL THEN 'missing_key' WHEN wk.o IS NULL THEN 'extra_key' WHEN wk.k <> fk.k THEN 'wrong_key' END, 'p', wk.k, fk.k FROM wk FULL JOIN fk ON wk.o = fk.o WHERE coalesce(wk.o, fk.o) IN (FROM both_))
SELECT 's' AS table_schema, 'o' || o AS table_name, violation, item, wanted, found FROM found WHERE violation IS NOT NULL"""
)
def contract_violations(spark, sf_dir):
    """Orders as tables of which the contract and the database each lack some, with lines as columns."""
    o, l = F.col("l_orderkey"), F.col("l_linenumber")  # noqa: E741
    lines = I.read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("low"), F.max("l_returnflag").alias("high"), (F.min("l_partkey") % 2 == 0).alias("nullable"))

    def columns(rows, kind):
        place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber"))
        return rows.select(o.alias("o"), F.lit("s").alias("table_schema"), F.concat(F.lit("o"), o.cast("string")).alias("table_name"), place.alias("position"), F.concat(F.lit("c"), l.cast("string")).alias("column_name"), kind.alias("data_type"), "nullable")

    def keys(rows, reverse):
        listed = rows.where("position <= 2").groupBy("o", "table_schema", "table_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "column_name"))), lambda x: x.column_name).alias("columns"))
        return listed.select("table_schema", "table_name", F.lit("p").alias("key_type"), F.when(reverse, F.reverse("columns")).otherwise(F.col("columns")).alias("columns"))

    wanted = columns(lines.where((o % 13 > 0) & ((o + l) % 9 > 0)), F.col("low"))
    found = columns(lines.where((o % 11 > 0) & ((o + l) % 7 > 0)), F.when(o % 5 == 0, F.col("high")).otherwise(F.col("low")))
    n = F.col("o")
    return contract.violations(wanted.drop("o"), found.drop("o"), keys(wanted.where(n % 8 > 0), F.lit(False)), keys(found.where(n % 6 > 0), n % 4 == 0))


@_query("WITH x AS (SELECT o_orderkey, o_totalprice, o_orderdate FROM orders) SELECT strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS build_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000000Z') AS iso, count(*) AS n FROM x GROUP BY 1, 2")
def time_texts(spark, sf_dir):
    at = F.col("o_orderdate").cast("timestamp")
    return I.read(spark, sf_dir, "orders").groupBy(S.build_id(at).alias("build_id"), S.iso_utc(at).alias("iso")).agg(F.count("*").alias("n"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide frame of all series' features."""
    return wide_gold(spark, sf_dir).orderBy("observation_date")
