import pytest
from pyspark.sql import functions as F

from stratum.sources.kafka import kafka_available, parse_payload, telemetry_bronze_stream


def test_kafka_source_fails_fast_without_connector(spark):
    if kafka_available(spark):
        pytest.skip("connector present")
    with pytest.raises(RuntimeError, match="Kafka connector"):
        telemetry_bronze_stream(spark, "localhost:9092", "telemetry")


def test_payload_parsing_keeps_bad_payloads(spark):
    bronze = spark.createDataFrame([('{"vin": "V1", "speed": 42.5}',), ("not json",)], "payload string")
    out = parse_payload(bronze, "vin string, speed double").orderBy(F.col("vin").asc_nulls_last()).collect()
    assert (out[0]["vin"], out[0]["speed"]) == ("V1", 42.5)
    assert out[1]["vin"] is None and out[1]["payload"] == "not json"
