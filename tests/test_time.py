from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hourcast.functions import time as t

STAMPS = ["2017-07-01 00:59:59.999999", "2024-03-31 02:30:00", "1969-12-31 23:30:00", "2024-10-27 02:00:00"]


def stamps(spark):
    return spark.createDataFrame([(s,) for s in STAMPS], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("ts")
    )


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_hours_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = stamps(spark).select(
            t.hour_of("ts").cast("string").alias("hour"),
            t.hour_offset(t.hour_of("ts"), datetime(2017, 7, 1)).alias("o"),
            t.add_hours(t.hour_of("ts"), 1).cast("string").alias("next"),
        )
        rows = [tuple(row) for row in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r[0] for r in rows] == [s[:13] + ":00:00" for s in STAMPS]
    hours = [datetime.fromisoformat(r[0]) for r in rows]
    assert [r[1] for r in rows] == [
        int((h - datetime(2017, 7, 1)).total_seconds() // 3600) for h in hours
    ]
    assert rows[1][2] == "2024-03-31 03:00:00"


def test_weekdays(spark):
    saturday = spark.sql("SELECT timestamp_ntz'2017-07-01 00:00:00' AS hour")
    row = saturday.select(t.iso_weekday("hour").alias("iso"), t.weekday("hour").alias("model")).first()
    assert (row["iso"], row["model"]) == (6, 5)


def test_months_before():
    assert t.months_before(date(2024, 2, 15)) == [(2023, 10), (2023, 11), (2023, 12), (2024, 1)]
    assert t.months_before(date(2024, 12, 31), 2) == [(2024, 10), (2024, 11)]
    assert len(t.months_before(None)) == 4


def test_parse_hour(spark):
    df = spark.createDataFrame([(" 2017-07-01 05",), ("2017-07-01 05:00:00.000",)], "s string")
    parsed = df.select(t.parse_hour("s").alias("h"))
    assert parsed.schema["h"].dataType.typeName() == "timestamp_ntz"
    assert {row["h"] for row in parsed.collect()} == {datetime(2017, 7, 1, 5)}
    with pytest.raises(Exception, match="CANNOT_PARSE"):
        spark.createDataFrame([("yesterday",)], "s string").select(t.parse_hour("s")).collect()


def test_hour_literal_must_be_a_full_hour():
    with pytest.raises(ValueError):
        t.hour_literal(datetime(2024, 1, 1, 0, 30))


def test_text_beside_the_full_hour_is_an_error(spark):
    for text in ("2024-01-01 05:30", "2024-01-01 05:30junk", "2024-01-01 05 x"):
        with pytest.raises(Exception, match="not a full hour"):
            spark.createDataFrame([(text,)], "s string").select(t.parse_hour("s")).collect()
    ok = spark.createDataFrame([("2024-01-01 05:00:00.000",), (None,)], "s string")
    assert [r[0] and r[0].hour for r in ok.select(t.parse_hour("s")).collect()] == [5, None]
