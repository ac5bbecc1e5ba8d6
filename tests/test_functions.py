import math

from pyspark.sql import functions as F

from marketlake.functions import casts, labels


def test_number_cast_rejects_what_is_not_a_number(spark):
    texts = ["1e3", " 12 ", "abc", "", "1d", "NaN", "1,000", "Infinity", "-.5", "+7.", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(casts.to_number(df, "x")).collect()]
    assert got == [1000.0, 12.0, None, None, None, None, None, None, -0.5, 7.0, None]


def test_number_cast_turns_nan_into_null(spark):
    df = spark.createDataFrame([(1.5,), (math.nan,), (None,)], "x double")
    assert [r[0] for r in df.select(casts.to_number(df, "x")).collect()] == [1.5, None, None]
    assert df.select(casts.to_number(df, "absent")).first()[0] is None


def test_timestamps_are_parsed_row_by_row(spark):
    texts = ["2024-01-15T09:30:00+00:00", "2024-01-15T09:30:00.123+00:00", "2024-01-15T09:30:00",
             "2024-01-15T11:30:00+02:00", "2024", "09:30", "bad", None]
    df = spark.createDataFrame([(t,) for t in texts], "timestamp string")
    got = [r[0] for r in df.select(F.date_format(casts.to_utc(df), "yyyy-MM-dd HH:mm:ss.SSS")).collect()]
    assert got == ["2024-01-15 09:30:00.000", "2024-01-15 09:30:00.123", "2024-01-15 09:30:00.000",
                   "2024-01-15 09:30:00.000", None, None, None, None]


def test_reasons_keep_declaration_order_and_ignore_null_predicates(spark):
    df = spark.createDataFrame([(1,)], "x int")
    reasons = labels.invalid_reasons({"b": F.lit(True), "n": F.lit(None).cast("boolean"), "a": F.col("x") == 1, "z": F.lit(False)})
    assert df.select(reasons).first()[0] == "b|a"
    assert df.select(labels.invalid_reasons({})).first()[0] == ""


def test_exact_sum_does_not_depend_on_row_order_and_keeps_huge_values(spark):
    values = [0.1, 0.2, 0.3, 1e9, 0.4]
    sums = set()
    for order in (values, values[::-1], sorted(values)):
        df = spark.createDataFrame([(v,) for v in order], "x double").coalesce(1)
        sums.add(df.agg(casts.exact_sum(F.col("x"), casts.PRICE)).first()[0])
    assert sums == {1000000001.0}
    huge = spark.createDataFrame([(1e30,), (1.0,)], "x double")
    assert huge.agg(casts.exact_sum(F.col("x"), casts.PRICE)).first()[0] == 1e30 + 1.0
    none = spark.createDataFrame([(None,)], "x double")
    assert none.agg(casts.exact_sum(F.col("x"), casts.PRICE)).first()[0] is None


def test_round_half_away_rounds_the_scaled_value(spark):
    df = spark.createDataFrame([(35894.64975,), (2.5,), (-2.5,)], "x double")
    assert [r[0] for r in df.select(casts.round_half_away(F.col("x"), 4)).collect()][0] == round(35894.64975 * 1e4) / 1e4
    assert [r[0] for r in df.select(casts.round_half_away(F.col("x"), 0)).collect()][1:] == [3.0, -3.0]
