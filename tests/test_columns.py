import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.functions import columns as C


def one(spark, *columns, **values):
    """The columns over a single row."""
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return tuple(df.select(*columns).first())


def test_numbers(spark):
    assert one(
        spark, C.safe_cast(F.lit("x"), "int"), C.safe_cast(F.lit("7"), "int"), C.safe_divide(F.lit(1), F.lit(0)),
        C.div(F.lit(-7), F.lit(2)), C.div(F.lit(7), F.lit(0))
    ) == (None, 7, None, -3, None)
    null = F.lit(None).cast("int")
    assert one(
        spark, C.greatest_strict(F.lit(1), F.lit(3)), C.greatest_strict(F.lit(1), null), C.least_strict(F.lit(1), null)
    ) == (3, None, None)


def test_readable_size(spark):
    assert one(
        spark, *(C.readable_size(F.lit(n)) for n in (0, 1023, 1024, 5 << 20, 3 << 30, 1 << 40))
    ) == ("0 B", "1023 B", "1.00 KB", "5.00 MB", "3.00 GB", "1.00 TB")
    assert one(spark, C.readable_size(F.lit(None).cast("long"))) == (None,)


def test_distance(spark):
    assert one(
        spark, C.distance_km(F.lit(0.0), F.lit(0.0), F.lit(180.0), F.lit(0.0)),
        C.distance_km(F.lit(105.85), F.lit(21.03), F.lit(106.66), F.lit(10.76))
    ) == (20015.09, pytest.approx(1145.3, abs=3))


def test_text(spark):
    text = F.lit("a-b-c-b")
    assert one(
        spark, C.nth_index(text, "b", 1), C.nth_index(text, "b", 2), C.nth_index(text, "b", 3),
        C.nth_index(text, "-", 3)
    ) == (3, 7, 0, 6)
    assert one(
        spark, C.part_at(text, "-", 0), C.part_at(text, "-", -1), C.part_at(text, "-", 9),
        C.part_at(F.lit("a.b"), ".", 1)
    ) == ("a", "b", None, "b")
    assert one(
        spark, C.extract(F.lit("x12"), "[0-9]+"), C.extract(F.lit("x"), "[0-9]+"),
        C.contains_any_case(F.lit("AbC"), "bc")
    ) == ("12", None, True)


def test_fail_if(spark):
    assert one(spark, C.fail_if(F.lit(False), "no", F.lit(1))) == (1,)
    with pytest.raises(Exception, match="no such thing"):
        one(spark, C.fail_if(F.lit(True), "no such thing", F.lit(1)))


@pytest.mark.parametrize(
    ("part", "later", "earlier", "want"),
    [
        ("MONTH", "2024-03-01", "2024-02-29", 1), ("YEAR", "2024-01-01", "2023-12-31", 1),
        ("WEEK", "2024-01-08", "2024-01-07", 1), ("WEEK", "2024-01-07", "2024-01-01", 0),
        ("QUARTER", "2024-04-01", "2024-03-31", 1), ("DAY", "2024-02-28", "2024-03-01", -2)
    ]
)
def test_date_diff_counts_boundaries(spark, part, later, earlier, want):
    d = lambda x: F.lit(x).cast("date")
    assert one(spark, C.date_diff(part, d(later), d(earlier))) == (want,)


@given(st.dates(dt.date(1990, 1, 1), dt.date(2040, 12, 31)))
@settings(max_examples=30, deadline=None)
def test_week_of_year_is_strftime_w(spark, day):
    assert one(spark, C.week_of_year(F.lit(day))) == (int(day.strftime("%W")),)


def test_dates_from_text(spark):
    texts = [
        "022024", "31012024", "31/01/2024", "2024-01-31", "2024-01-31T10:00:00.000Z", "99/99/2024", "junk", "", None
    ]
    want = ["2024-02-01", "2024-01-31", "2024-01-31", "2024-01-31", "2024-01-31", None, None, None, None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    assert [
        r.d and r.d.isoformat() for r in df.select("i", C.normalise_date("s").alias("d")).orderBy("i").collect()
    ] == want


def test_ages_and_buckets(spark):
    d = lambda x: F.lit(x).cast("date")
    assert one(
        spark, C.age_years(d("2000-02-29"), d("2024-02-28")), C.age_years(d("2000-02-29"), d("2024-02-29"))
    ) == (23, 24)
    assert one(
        spark,
        *(
            C.expiry_bucket(d(x), d("2024-01-01")) for x in (
                "2023-12-31", "2024-03-31", "2024-06-29", "2024-12-31", "2030-01-01"
            )
        )
    ) == ("expired", "0-3 months", "3-6 months", "6-12 months", "over 12 months")


def test_local_time_and_ids(spark):
    at = F.lit("2024-01-01 20:00:00").cast("timestamp")
    assert one(
        spark, C.to_local(at, "Asia/Ho_Chi_Minh"), C.created_partition(at, "Asia/Ho_Chi_Minh"),
        C.created_partition(F.lit(None).cast("timestamp"), "UTC")
    ) == (dt.datetime(2024, 1, 2, 3), dt.date(2024, 1, 2), dt.date(2099, 1, 1))
    assert one(
        spark, F.unix_seconds(C.object_id_time(F.lit("65920080aaaaaaaaaaaaaaaa"))), C.object_id_time(F.lit("nothex00"))
    ) == (0x65920080, None)


def test_python_date_helpers():
    assert C.past_date(dt.date(2024, 3, 31), months=1) == dt.date(2024, 2, 29)
    assert C.past_date(dt.date(2024, 1, 15), days=15, months=12) == dt.date(2022, 12, 31)
    assert C.past_datetime(dt.datetime(2024, 1, 1, 5), days=1) == dt.datetime(2023, 12, 31, 5)
    assert C.is_day_of_week(dt.date(2024, 1, 7), 1) and not C.is_day_of_week(dt.date(2024, 1, 7), 2, 3)
    assert C.relative_range("l2w", dt.date(2024, 1, 15)) == (dt.date(2024, 1, 1), dt.date(2024, 1, 15))
    assert C.relative_range("2024-01-01, 2024-02-01", dt.date(2030, 1, 1)) == (dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    with pytest.raises(ValueError, match="no range"):
        C.relative_range("last", dt.date(2024, 1, 1))


def test_formats(spark):
    assert C.strftime_pattern("%d/%m/%Y at %H") == "dd/MM/yyyy 'a''t' HH"
    assert one(
        spark, C.format_time(F.lit("2024-05-06 07:08:09").cast("timestamp"), "%F %T")
    ) == ("2024-05-06 07:08:09",)


def test_json_and_arrays(spark):
    texts = ["{}", '{a,NULL,"b"}', "plain", '{"x, y",z}', None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    assert [
        r.a for r in df.select("i", C.parse_pg_array("s").alias("a")).orderBy("i").collect()
    ] == [[], ["a", None, "b"], ["plain"], ["x, y", "z"], None]
    assert one(
        spark, C.json_array(F.lit("[1,2]"), "int"), C.json_array(F.lit("[]"), "int"), C.json_array(F.lit("x"), "int")
    ) == ([1, 2], [], None)
    pairs = F.array(
        F.struct(F.lit("a").alias("key"), F.lit(1).alias("value")),
        F.struct(F.lit("a").alias("key"), F.lit(2).alias("value"))
    )
    assert one(
        spark, C.lookup(pairs, "a"), C.lookup(pairs, "b"),
        C.last_valid(F.array(F.lit("x"), F.lit(""), F.lit(None).cast("string")))
    ) == (2, None, "x")
