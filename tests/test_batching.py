from datetime import date, timedelta

from pyspark.sql import functions as F

from hitledger.functions.batching import calendar_day, iso_week, register_week_batch_id, week_batch_id

DAYS = [date(1994, 12, 1) + timedelta(days=n) for n in range(0, 12_000)]

ODD = {
    None: 0,
    "": 0,
    "1995-7-1": 0,
    "1995-02-30": 0,
    "1995-07-45": 0,
    "1995-07-01 ": 0,
    "1995-07-01T00:00": 0,
    "95-07-01": 0,
    "12345-07-01": 0,
    "+1995-07-01": 0,
    "+12345-07-01": 1234526,
    "-1234-07-01": -123374,
    "-0000-07-01": 0,
    "+6000000-07-01": 600000026,
    "-6000000-01-01": -600000048,
    "+999999999-07-01": (999999999 * 100 + 26 + 2**31) % 2**32 - 2**31,
    "+1000000000-07-01": 0,
    "0000-07-01": 26,
    "0095-07-01": 9526,
    "yesterday": 0,
}


def test_weeks_agree_with_the_calendar(spark):
    df = spark.createDataFrame([(str(day),) for day in DAYS], "log_date string")
    got = dict(df.select("log_date", week_batch_id("log_date").alias("week")).collect())
    for day in DAYS:
        year, week, _ = day.isocalendar()
        assert got[str(day)] == year * 100 + week


def test_odd_texts_and_the_sql_function(spark):
    register_week_batch_id(spark)
    df = spark.createDataFrame([(text,) for text in ODD], "log_date string")
    df.createOrReplaceTempView("dates")
    rows = df.select("log_date", week_batch_id("log_date").alias("week")).collect()
    assert {row["log_date"]: row["week"] for row in rows} == ODD
    rows = spark.sql("SELECT log_date, week_batch_id(log_date) AS week FROM dates").collect()
    assert {row["log_date"]: row["week"] for row in rows} == ODD


def test_numbers_and_texts_give_the_same_week(spark):
    years = [-1000000000, -999999999, -6000000, -20000, -12345, -1000, -999, -1, 0, 4, 95, 1900, 1995, 2000, 9999, 10000, 2147483647, -2147483648]
    df = spark.createDataFrame([(y,) for y in years], "y int")
    df = df.select("y", F.explode(F.expr("sequence(1, 12)")).alias("m"))
    df = df.select("*", F.explode(F.expr("array(-1, 0, 1, 28, 29, 30, 31, 32, 123, 2147483647)")).alias("d"))
    text = F.format_string("%04d-%02d-%02d", "y", "m", "d").alias("text")
    df = df.select("*", text).select(
        "*", F.expr(iso_week(f"({calendar_day('y', 'm', 'd')})", "y")).alias("a"), week_batch_id("text").alias("b")
    )
    assert df.filter("a IS DISTINCT FROM b").collect() == []
    assert df.filter("a <> 0").count() > 300
