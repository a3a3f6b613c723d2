"""Envelope parsing edge cases (F1) and the bounded envelope builder."""
import json

from pyspark.sql import functions as F

from quotelake.functions import envelope
from quotelake.schemas import COIN_SCHEMA, ENVELOPE_SCHEMA
from quotelake.sources.adapters import event_quotes
from tests.conftest import SF001


def _messages(spark, bodies):
    return spark.createDataFrame([(b,) for b in bodies], "value string")


def test_quote_layout():
    text, whole, real = "string", "bigint", "double"
    assert [(f.name, f.dataType.simpleString()) for f in COIN_SCHEMA] == [
        ("id", text), ("symbol", text), ("name", text), ("current_price", real), ("market_cap", whole),
        ("total_volume", whole), ("price_change_percentage_24h", real), ("high_24h", real), ("low_24h", real),
        ("circulating_supply", real), ("total_supply", real), ("max_supply", real), ("last_updated", text)]
    assert [f.dataType.typeName() for f in ENVELOPE_SCHEMA] == ["string", "array"]


def test_supplies_survive_the_round_trip(spark):
    q = event_quotes(spark, SF001).limit(3).withColumns(
        {"circulating_supply": F.lit(7.0), "total_supply": F.lit(8.0), "max_supply": F.lit(9.0)})
    back = envelope.parse_envelopes(envelope.to_envelopes(q, F.lit("t")))
    assert {(r.circulating_supply, r.total_supply, r.max_supply) for r in back.collect()} == {(7.0, 8.0, 9.0)}


def test_envelope_ids_must_be_integers(spark):
    import pytest
    with pytest.raises(TypeError):
        envelope.to_envelopes(event_quotes(spark, SF001).withColumn("row_id", F.col("row_id").cast("string")), F.lit("t"))


def test_edge_messages_yield_no_rows(spark):
    bodies = ["not json", '{"ingested_at":"a","coins":[]}', '{"ingested_at":"b"}']
    assert envelope.parse_envelopes(_messages(spark, bodies)).count() == 0
    rej = {r.reason for r in envelope.envelope_rejects(_messages(spark, bodies)).collect()}
    assert rej == {"unparsable", "empty_coins", "no_coins"}


def test_fractional_or_text_numbers_become_null(spark):
    body = json.dumps({"ingested_at": "t", "coins": [
        {"id": "x", "symbol": "x", "total_volume": 20.0},
        {"id": "y", "symbol": "y", "total_volume": 30.5},
        {"id": "z", "symbol": "z", "current_price": "12.5", "market_cap": 1.0e3},
        {"id": "n", "symbol": None},
    ]})
    rows = {r.id: r for r in envelope.parse_envelopes(_messages(spark, [body])).collect()}
    assert len(rows) == 4
    assert rows["x"].total_volume is None and rows["y"].total_volume is None
    assert rows["z"].current_price is None and rows["z"].market_cap is None
    assert rows["n"].symbol is None


def test_documented_example_row(spark):
    body = json.dumps({"ingested_at": "2024-01-01T00:00:00+00:00", "coins": [
        {"id": "bitcoin", "symbol": "btc", "name": "Bitcoin", "current_price": 74288.0,
         "market_cap": 1340000000000, "total_volume": 44167880203,
         "price_change_percentage_24h": 2.5}]})
    r = envelope.parse_envelopes(_messages(spark, [body])).first()
    assert (r.id, r.symbol, r.name, r.current_price, r.market_cap, r.total_volume,
            r.price_change_pct_24h) == ("bitcoin", "btc", "Bitcoin", 74288.0, 1340000000000,
                                       44167880203, 2.5)


def test_binary_payload_parses(spark):
    df = spark.createDataFrame([(bytearray(b'{"ingested_at":"a","coins":[{"id":"btc"},{"id":"eth"}]}'),)],
                               "value binary")
    assert [r.id for r in envelope.parse_envelopes(df).collect()] == ["btc", "eth"]


def test_envelopes_are_capped_and_lossless(spark):
    q = event_quotes(spark, SF001)
    env = envelope.to_envelopes(q, envelope.iso_utc(F.date_trunc("day", "recorded_at")), max_quotes=7)
    assert env.agg(F.max("n_coins")).first()[0] <= 7
    back = envelope.parse_envelopes(env)
    assert back.count() == q.count()
    cols = ["id", "symbol", "name", "current_price", "market_cap", "total_volume", "last_updated"]
    orig = q.select("id", "symbol", "name", F.col("price_usd").alias("current_price"), "market_cap",
                    F.col("volume_24h").alias("total_volume"), "last_updated")
    assert back.select(*cols).exceptAll(orig).count() == 0


def test_to_raw_lake_renames(spark):
    body = '{"ingested_at":"a","coins":[{"id":"btc","current_price":1.0,"total_volume":5}]}'
    raw = envelope.to_raw_lake(envelope.parse_envelopes(_messages(spark, [body])))
    assert {"price_usd", "volume_24h", "recorded_at"} <= set(raw.columns)
    assert "current_price" not in raw.columns


def test_lenient_numbers(spark):
    body = json.dumps({"ingested_at": "t", "coins": [
        {"id": "x", "total_volume": 20.0, "market_cap": 1.0e3, "current_price": "12.5"},
        {"id": "y", "total_volume": 30.5, "market_cap": 7, "current_price": 3},
        {"id": "z", "total_volume": "abc", "current_price": None},
    ]})
    rows = {r.id: r for r in envelope.parse_envelopes(_messages(spark, [body]),
                                                      lenient_numbers=True).collect()}
    assert (rows["x"].total_volume, rows["x"].market_cap, rows["x"].current_price) == (20, 1000, 12.5)
    assert (rows["y"].total_volume, rows["y"].market_cap, rows["y"].current_price) == (None, 7, 3.0)
    assert rows["z"].total_volume is None and rows["z"].current_price is None
    strict = envelope.parse_envelopes(_messages(spark, [body])).schema
    assert envelope.parse_envelopes(_messages(spark, [body]), lenient_numbers=True).schema == strict


def test_iso_utc_stamps(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 678901),)], "t timestamp_ntz")
    r = df.select(envelope.iso_utc(F.col("t")).alias("s"),
                  envelope.iso_utc(F.col("t"), micros=True).alias("m")).first()
    assert r.s == "2024-01-02T03:04:05+00:00"
    assert r.m == dt.datetime(2024, 1, 2, 3, 4, 5, 678901, tzinfo=dt.timezone.utc).isoformat()
