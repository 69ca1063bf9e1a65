import json
from datetime import UTC, date, datetime

import pytest

from tideline import registry, schemas
from tideline.sources import payloads as P
from tideline.plans import planner
from tideline.sources import providers
from tideline.sources.http import Response, TransportError, fetch, waits


@pytest.fixture
def put(tmp_path):
    def write(text: str, name: str = "x") -> str:
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    return write


def values(df):
    return [tuple(r) for r in df.orderBy("observation_date").collect()]


def test_ohlc_csv(spark, put):
    head = " Date ,Open,high,LOW,CLOSE\n"
    good = put(head + "01/02/2024,1,3,0.5,2\n2024-01-03,1,0.5,2,1\n01/04/2024,2,2,2,2\n")
    assert [r[0] for r in values(P.ohlc_csv(spark, good))] == [date(2024, 1, 2), date(2024, 1, 4)]
    for bad in (head + "x,1,3,0.5,2\n", head + "01/02/2024,1,3,0.5,\n", head + "01/02/2024,1,0,2,1\n", head + "01/02/2024,1,3,0.5,2\n2024-01-02,1,3,0.5,2\n", "DATE,OPEN,HIGH,LOW\n01/02/2024,1,3,1\n", head + "01/02/2024,NaN,3,0.5,2\n"):
        with pytest.raises(P.PayloadError):
            P.ohlc_csv(spark, put(bad)).collect()


def test_scalar_text(spark, put):
    for text in ("DATE;V2TX\n02.01.2024;15.5\n", "Date\tSymbol\tIndexvalue\n2024-01-02\tV\t15.5\n", "time_period,OBS_VALUE\n02/01/2024,15.5\n"):
        assert values(P.scalar_text(spark, put(text))) == [(date(2024, 1, 2), 15.5)]
    for bad in ("DATE;X\n02.01.2024;1\n", "DATE;V2TX\nbad;1\n", "DATE;V2TX\n02.01.2024;x\n", "DATE;V2TX\n02.01.2024;NaN\n", "DATE;V2TX\n02.01.2024;1\n2024-01-02;2\n"):
        with pytest.raises(P.PayloadError):
            P.scalar_text(spark, put(bad)).collect()


def test_sdmx_csv(spark, put):
    assert values(P.sdmx_csv(spark, put("KEY,TIME_PERIOD,OBS_VALUE\na,2024-01-02,1.5\na,2024-01-03,.\na,2024-01-04,\na,2024-01-05,2\n"))) == [(date(2024, 1, 2), 1.5), (date(2024, 1, 5), 2.0)]
    assert values(P.sdmx_csv(spark, put(""))) == []
    for bad in ("bad", "nan", "inf"):
        with pytest.raises(P.PayloadError):
            P.sdmx_csv(spark, put(f"TIME_PERIOD,OBS_VALUE\n2024-01-02,{bad}\n"))
    with pytest.raises(P.PayloadError):
        P.sdmx_csv(spark, put("TIME_PERIOD,OBS_VALUE\n2024-01-02,1\n2024-01-02,2\n"))


def chart(at, error=None, **vectors):
    return json.dumps({"chart": {"error": error, "result": [{"timestamp": at, "indicators": {"quote": [vectors]}}]}})


def test_chart_json(spark, put):
    good = chart([1704153600, 1704240000], open=[1, None], high=[3, None], low=[0.5, None], close=[2, None])
    assert values(P.chart_json(spark, put(good))) == [(date(2024, 1, 2), 1.0, 3.0, 0.5, 2.0)]
    assert values(P.chart_json(spark, put('{"chart": {"error": null, "result": []}}'))) == []
    for bad in (
        chart([1704153600], error="no", open=[1], high=[3], low=[1], close=[2]),
        chart([1704153600], open=[1, 2], high=[3], low=[1], close=[2]),
        chart([1704153600], open=[1], high=[3], low=[1], close=[None]),
        chart([1704153600], open=[1], high=[0], low=[2], close=[2]),
        chart([1704153600, 1704153601], open=[1, 1], high=[3, 3], low=[1, 1], close=[2, 2]),
        "no json",
    ):
        with pytest.raises(P.PayloadError):
            P.chart_json(spark, put(bad)).collect()


def test_observations_json(spark, put):
    o = lambda *pairs: json.dumps({"observations": [{"date": d, "value": v} for d, v in pairs]})
    assert values(P.observations_json(spark, put(o(("2024-01-02", "1.5"), ("2024-01-03", "."), ("2024-01-04", ""), ("2024-01-05", None))))) == [(date(2024, 1, 2), 1.5)]
    for bad in (o(("2024-01-02", "x")), o(("2024-01-02", "1"), ("2024-01-02", "2")), o(("x", "1")), '{"observations": 5}', "{}"):
        with pytest.raises(P.PayloadError):
            P.observations_json(spark, put(bad)).collect()


def test_observations_have_the_stored_schema(spark, put):
    at = datetime(2024, 1, 5, tzinfo=UTC)
    for s, text in (("vix", "DATE,OPEN,HIGH,LOW,CLOSE\n01/02/2024,1,3,0.5,2\n"), ("us_2y", '{"observations": [{"date": "2024-01-02", "value": "1"}]}')):
        series = registry.series(s)
        df = P.observations(spark, series, put(text, s), at, "u")
        assert schemas.same_schema(df, schemas.bronze(series.shape)) and df.count() == 1
    with pytest.raises(P.PayloadError):
        P.observations(spark, registry.series("vix"), put(""), datetime(2024, 1, 5), "u")


def test_retries():
    slept, answers = [], [Response(503, b"", {"Retry-After": "99"}), Response(429, b"", {}), Response(200, b"ok", {})]
    assert fetch("http://h/p", {"key": "secret"}, send=lambda url: answers.pop(0), sleep=slept.append).body == b"ok"
    assert slept == [8.0, 1.0]
    sent = []
    with pytest.raises(TransportError) as caught:
        fetch("http://h/p", {"key": "secret"}, send=lambda url: sent.append(url) or Response(404, b"", {}), sleep=slept.append)
    assert len(sent) == 1 and "secret" not in str(caught.value)

    def broken(url):
        sent.append(url)
        raise ConnectionError("secret")

    with pytest.raises(TransportError) as caught:
        fetch("http://h/p", {"key": "secret"}, send=broken, sleep=slept.append)
    assert "secret" not in str(caught.value) and "ConnectionError" in str(caught.value) and len(sent) == 4
    for bad in ({"attempts": 0}, {"longest": -1}, {"first": -1}):
        with pytest.raises(ValueError):
            waits(**bad)
    assert list(waits(6)) == [0.5, 1.0, 2.0, 4.0, 8.0] and list(waits(3, 4)) == [4.0, 8.0] and list(waits(1)) == []


FIRST, LAST = date(2024, 1, 2), date(2024, 1, 9)
ALL, UPDATE = planner.Fetch("bootstrap", None, LAST, True), planner.Fetch("update", FIRST, LAST, False, FIRST, LAST)


def test_requests_of_each_provider():
    asked = lambda name, plan: providers.request(registry.series(name), plan, {"fred": "secret"})
    url, query = asked("move", UPDATE)
    assert url.endswith("/%5EMOVE") and (query["period1"], query["period2"]) == ("1704153600", "1704844800")  # the end is left out, so it is a day later
    assert asked("move", ALL)[1]["period1"] == "0"
    url, query = asked("ciss", UPDATE)
    assert url.endswith("/CISS/D.U2.Z0Z.4F.EC.SS_CIN.IDX") and (query["startPeriod"], query["endPeriod"]) == ("2024-01-02", "2024-01-09")
    assert "startPeriod" not in asked("ciss", ALL)[1]
    url, query = asked("us_2y", UPDATE)
    assert (query["series_id"], query["api_key"], query["observation_start"], query["observation_end"]) == ("DGS2", "secret", "2024-01-02", "2024-01-09") and "secret" not in url
    assert asked("vix", planner.Fetch("update", None, LAST, False, FIRST, LAST)) == ("https://cdn.cboe.com/api/global/us_indices/daily_prices/VIX_History.csv", {}) and asked("vstoxx", ALL)[1] == {}
    with pytest.raises(planner.PlanError):
        providers.request(registry.series("us_2y"), UPDATE)
    with pytest.raises(planner.PlanError):
        asked("move", planner.Fetch("update", None, LAST, False, FIRST, LAST))


def test_fetching_lands_and_reads(spark, tmp_path):
    sent = []

    def fetcher(status, body):
        return providers.fetcher(spark, str(tmp_path), lambda: datetime(2024, 1, 10, tzinfo=UTC), {"fred": "secret"}, send=lambda url: sent.append(url) or Response(status, body, {}), sleep=lambda s: None)

    payload = json.dumps({"observations": [{"date": "2024-01-03", "value": "4.5"}, {"date": "2024-01-04", "value": "."}, {"date": "2023-01-03", "value": "4.0"}]}).encode()
    rows = fetcher(200, payload)(registry.series("us_2y"), UPDATE)
    assert sorted((str(r.observation_date), r.value, r.source_url) for r in rows.collect()) == [(d, v, "https://api.stlouisfed.org/fred/series/observations") for d, v in (("2023-01-03", 4.0), ("2024-01-03", 4.5))]
    assert "secret" in sent[0] and len(list((tmp_path / "us_2y").iterdir())) >= 1
    with pytest.raises(planner.PlanError):  # a day outside the window that was asked for
        planner.apply_window(rows, UPDATE, P.ON_LATE["fred"])
    assert fetcher(404, b"No records found")(registry.series("ciss"), UPDATE).collect() == []
    for name, status, body in (("ciss", 404, b"gone"), ("us_2y", 404, b"no data"), ("vix", 500, b"no data"), ("us_2y", 400, b"bad key")):
        with pytest.raises(TransportError) as caught:
            fetcher(status, body)(registry.series(name), ALL)
        assert "secret" not in str(caught.value)
