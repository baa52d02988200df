from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lateparcel import functions as X
from lateparcel.operators import train


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).head()["x"]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "later, earlier, days",
    [
        ("2024-01-02 00:00:00", "2024-01-01 12:00:00", 0),
        ("2024-01-01 00:00:00", "2024-01-01 12:00:00", -1),
        ("2024-01-02 01:00:00", "2024-01-01 23:00:00", 0),
        ("2024-01-03 00:00:00", "2024-01-01 00:00:00", 2),
        ("2024-01-01 00:00:00", "2024-01-03 00:00:00", -2),
        ("2024-01-01 00:00:00", "2024-01-01 00:00:00.000001", -1),
    ],
)
def test_days_are_rounded_down(spark, later, earlier, days):
    assert one(spark, X.floored_days(ts(later), ts(earlier))) == days


def test_days_ignore_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # a night with a clock change
        got = one(spark, X.floored_days(ts("2018-11-05 00:00:00"), ts("2018-11-03 00:00:00")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == 2


def test_unknown_dates_give_unknown_days(spark):
    assert one(spark, X.floored_days(ts(None), ts("2024-01-01"))) is None


def test_text_cleaning(spark):
    assert one(spark, X.clean_city(F.lit(" São Paulo\t"))) == "são paulo"
    assert one(spark, X.clean_state(F.lit("\n sp "))) == "SP"
    assert one(spark, X.clean_city(F.lit(None).cast("string"))) == "desconocido"
    assert one(spark, X.clean_state(F.lit(None).cast("string"))) == "DESCONOCIDO"


def test_lenient_and_strict_parsing(spark):
    assert one(spark, X.lenient_number(F.lit("01310"))) == 1310.0
    assert one(spark, X.lenient_number(F.lit("abc"))) is None
    assert one(spark, X.lenient_timestamp(F.lit("soon"))) is None
    assert one(spark, X.strict_timestamp(F.lit("2024-02-03 04:05:06"))) == datetime(
        2024, 2, 3, 4, 5, 6
    )
    with pytest.raises(Exception):
        one(spark, X.strict_timestamp(F.lit("soon")))


def test_flags_treat_unknown_as_no(spark):
    rows = spark.createDataFrame([(3,), (0,), (-1,), (None,)], "d long")
    assert [r[0] for r in rows.select(X.late_flag("d")).collect()] == [1, 0, 0, 0]


def test_rounding_is_half_to_even(spark):
    assert one(spark, X.half_even(F.lit(0.125), 2)) == 0.12
    assert one(spark, X.half_even(F.lit(0.375), 2)) == 0.38


def test_gaps(spark):
    assert one(spark, X.relative_gap(F.lit(0.0), F.lit(1.0))) is None
    assert one(spark, X.relative_gap(F.lit(2.0), F.lit(3.0))) == pytest.approx(0.5)
    assert one(spark, X.absolute_gap(F.lit(2.0), F.lit(3.5))) == 1.5


def test_texts(spark):
    assert one(spark, X.mean_pm_std(F.lit(0.84123), F.lit(0.02))) == "0.8412 ± 0.0200"
    assert X.params_text({"b": 1, "a": None}) == '{"a":null,"b":1}'
    assert one(spark, X.params_column({"b": F.lit(1), "a": F.lit("x")})) == '{"a":"x","b":1}'


def test_hash_tells_where_a_null_is(spark):
    frame = spark.createDataFrame([(None, "a"), ("a", None), ("a", "")], "x string, y string")
    assert frame.select(X.portable_hash(["x", "y"])).distinct().count() == 3


def test_too_deep_trees_are_refused():
    assert train._depth(None) == 30 and train._depth(12) == 12
    with pytest.raises(ValueError, match="40"):
        train._depth(40)
