from decimal import Decimal

from pyspark.sql import functions as F

from larchmart.functions.columns import avg_half_up, bool_flag, date_key, days_between, pct, quotient_half_up, surrogate_key


def test_surrogate_key_null_safe(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "")], "x string, y string")
    keys = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    assert len(set(keys)) == 3


def test_date_key_and_days_between(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-01-01 23:59:59' as a, timestamp_ntz'2024-01-02 00:00:01' as b, "
        "cast(null as timestamp_ntz) as n"
    )
    r = df.select(date_key("a").alias("k"), days_between("a", "b").alias("d"), date_key("n").alias("kn")).first()
    assert r.k == 20240101 and r.d == 1 and r.kn is None


def test_bool_flag_null_is_false(spark):
    df = spark.createDataFrame([(None,), (1,), (0,)], "x int")
    assert [r[0] for r in df.select(bool_flag(F.col("x") == 1)).collect()] == [False, True, False]


def test_pct_half_up_and_zero_guard(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("8.00")), (Decimal("1.00"), Decimal("0.00")), (Decimal("-1.00"), Decimal("8.00"))], "n decimal(12,2), d decimal(12,2)")
    assert [r[0] for r in df.select(pct("n", "d")).collect()] == [Decimal("12.50"), None, Decimal("-12.50")]


def test_quotient_half_up(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (7, 3), (-7, 3), (1, 0)], "n long, d long")
    got = [r[0] for r in df.select(quotient_half_up(F.col("n"), F.col("d"))).collect()]
    assert got == [3, -3, 2, -2, None]


def test_avg_half_up_exact_tie(spark):
    # 0.125 average rounds up to 0.13 exactly (no intermediate rounding)
    df = spark.createDataFrame([(Decimal("0.10"),), (Decimal("0.15"),), (Decimal("0.10"),), (Decimal("0.15"),)], "x decimal(14,2)")
    assert df.agg(avg_half_up(F.col("x"), 2)).first()[0] == Decimal("0.13")
    ints = spark.createDataFrame([(1,), (2,), (2,)], "x int")  # 1.666.. -> 1.67
    assert ints.agg(avg_half_up(F.col("x"), 0)).first()[0] == Decimal("1.67")
