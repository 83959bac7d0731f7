import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.functions import scalars as s


def values(spark, rows, column, ddl="x string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, {ddl}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_pad_cik_never_cuts(spark):
    assert values(spark, ["1", "0000000012", "123456789012", None], s.pad_cik("x")) == ["0000000001", "0000000012", "123456789012", None]


def test_strict_dates(spark):
    assert values(spark, ["2024-02-29", "2023-02-29", "2024-1-1", "x", None], s.iso_date("x")) == [dt.date(2024, 2, 29), None, None, None, None]


def test_timestamps_are_utc(spark):
    got = values(spark, ["2024-01-02T03:04:05.000Z", "2024-01-02T03:04:05+02:00", "2024-01-02", "bad", None], s.utc_timestamp("x").cast("string"))
    assert got == ["2024-01-02 03:04:05", "2024-01-02 01:04:05", "2024-01-02 00:00:00", None, None]


def test_fact_values(spark):
    texts = ["1000000", "NaN", "Infinity", "1d", "0x1p3", "1_000", "1e400", "-2.5e3", "", None]
    assert values(spark, texts, s.numeric_value("x")) == [1e6, None, None, None, None, None, None, -2500.0, None, None]
    assert values(spark, texts, s.text_value("x")) == [None, "NaN", "Infinity", "1d", "0x1p3", "1_000", "1e400", None, "", None]


def test_digits_and_truth(spark):
    assert values(spark, ["12", "1.5", "-1", "", None], s.digits("x")) == [12, None, None, None, None]
    assert values(spark, ["1", "0", "true", "false", "", "no", None], s.truthy("x")) == [True, False, True, False, False, True, None]


def test_error_classes(spark):
    texts = ["404 Not Found", "429 Client Error: Too Many Requests", "400 Bad Request", "timeout", "unable to open database file"]
    assert values(spark, texts, s.permanent_error("x")) == [True, False, True, False, False]
    assert values(spark, texts, s.retryable_error("x")) == [False, True, False, False, True]
    assert values(spark, texts, s.error_bucket("x")) == ["404", "429", "other", "other", "other"]


def test_clamp(spark):
    df = spark.createDataFrame([("2020-01-01", "2024-01-01"), ("2023-12-30", "2024-01-01")], "a string, b string").select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    assert [r[0] for r in df.select(s.clamp_start("a", "b", 10)).collect()] == [dt.date(2023, 12, 22), dt.date(2023, 12, 30)]


def test_html(spark):
    page = "<p>A&amp;B <b>c</b></p><script>x<1</script><table><tr><td>no</td></tr></table>\n d"
    assert values(spark, [page], s.html_text("x")) == ["A&B c d"]


def test_file_names(spark):
    assert values(spark, ["/a/CIK0000320193.json", "x"], s.cik_of_file("x")) == ["0000320193", ""]
    assert values(spark, ["batch_20240102_030405.parquet"], s.batch_time_of_file("x").cast("string")) == ["2024-01-02 03:04:05"]
