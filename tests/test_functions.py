from pyspark.sql import functions as F

from reelrank.functions.scalar import cosine, java_trim, log10_count, rating_month, split_fields


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_rating_month_utc(spark):
    assert one(spark, rating_month(F.lit(1193435061))) == 200710
    assert one(spark, rating_month(F.lit(0))) == 197001
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert one(spark, rating_month(F.lit(1193435061))) == 200710  # independent of session zone
        assert one(spark, rating_month(F.lit(1201824000))) == 200802  # 2008-02-01T00:00Z
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_java_trim_removes_control_chars(spark):
    assert one(spark, java_trim(F.lit("\t a b \r\n"))) == "a b"


def test_split_keeps_trailing_empty_fields(spark):
    assert one(spark, split_fields(F.lit("1^a^^"), "^")) == ["1", "a", "", ""]
    assert one(spark, split_fields(F.lit("1|2|3"), "|")) == ["1", "2", "3"]


def test_cosine_zero_norm_is_null(spark):
    z = F.array(F.lit(0.0), F.lit(0.0))
    a = F.array(F.lit(1.0), F.lit(0.0))
    assert one(spark, cosine(z, a)) is None
    assert abs(one(spark, cosine(a, F.array(F.lit(1.0), F.lit(1.0)))) - 2 ** -0.5) < 1e-12


def test_log10_count_defaults_to_one(spark):
    assert one(spark, log10_count(F.lit(None).cast("long"))) == 0.0
    assert one(spark, log10_count(F.lit(0))) == 0.0
    assert abs(one(spark, log10_count(F.lit(100))) - 2.0) < 1e-12
