import json

import pytest

from tapeflow.operators import ingest as I
from tapeflow.plans.pipelines import ingest_messages

GOOD = {"e": "trade", "s": "btc", "p": "1.5", "q": "2", "T": 1740754800123, "m": True, "t": 7}


def message(**changes):
    data = {k: v for k, v in (GOOD | changes).items() if v is not ...}
    return json.dumps({"data": data})


def check(spark, text, **options):
    table = spark.createDataFrame([(text,)], "value string")
    return I.validate_trades(I.unwrap_messages(table), **options).first()


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        (message(), None),
        (message(m=...), "missing_field"),
        (message(e=None), None),
        (message(p="abc"), "bad_type"),
        (message(q="0"), "non_positive"),
        (message(T=-1), "non_positive"),
        (message(p="NaN"), "non_finite"),
        (message(p="Infinity"), "non_finite"),
        (message(m="false"), "bad_type"),
        (message(m=1), "bad_type"),
        (message(t=None), "bad_type"),
        (message(T="12.5"), "bad_type"),
        (message(T="12"), None),
        (message(T=12.7), None),
        (message(p=" 1 "), None),
        (message(s=""), "empty_symbol"),
        (message(p=3, q=4.5), None),
        ("{}", "missing_field"),
        ('{"data": [1]}', "missing_field"),
        ("not json", "bad_json"),
    ],
)
def test_reject_reasons(spark, text, reason):
    assert check(spark, text).reject_reason == reason


def test_values(spark):
    row = check(spark, message())
    assert (row.symbol, row.price, row.quantity) == ("BTC", 1.5, 2.0)
    assert (row.timestamp_ms, row.trade_id, row.is_buyer_maker) == (1740754800123, 7, True)
    assert check(spark, message(m=..., t=...)).missing_keys == ["m", "t"]
    assert check(spark, message(p="NaN"), reject_non_finite=False).reject_reason is None


def test_raw_layer_keeps_everything(spark):
    table = spark.createDataFrame([(message(),), ("{}",), ("not json",), ("5",)], "value string")
    rows = I.unwrap_messages(table).select("raw", "parse_ok").collect()
    assert json.loads(rows[0].raw) == GOOD
    assert [r.raw for r in rows[1:]] == ["{}"] * 3
    assert [r.parse_ok for r in rows] == [True, True, False, True]


def test_text_is_parsed_once(spark):
    checked = I.validate_trades(I.unwrap_messages(spark.createDataFrame([("x",)], "value string")))
    accepted, _ = I.split_rejects(checked)
    plan = accepted.drop("raw", "value")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_every_message_is_accounted_for(spark):
    texts = [message(t=i, T=1000 + i, p=str(100 + i)) for i in range(20)]
    texts += [message(t=3, T=5000), message(t=4, T=5000, s="eth"), message(p="x"), "oops", "{}"]
    table = spark.createDataFrame([(t,) for t in texts], "value string")
    result = ingest_messages(table)
    report = {r.reject_reason: r.rejected for r in I.reject_report(result.rejects).collect()}
    assert report == {"duplicate": 1, "bad_type": 1, "bad_json": 1, "missing_field": 1}
    assert result.clean.count() + sum(report.values()) == len(texts)
    first = result.clean.filter("trade_id = 0").first()
    assert first.trade_value_usdt == 200.0 and first.source == "binance"
    assert first.trade_time == "1970-01-01T00:00:01.000000+00:00"


def test_iso_time_does_not_follow_the_session_zone(spark, trades):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        from pyspark.sql import functions as F

        table = trades(("A", 1.0, 1740754800123, 1)).withColumn("is_buyer_maker", F.lit(True))
        assert I.enrich_trades(table).first().trade_time == "2025-02-28T15:00:00.123000+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
