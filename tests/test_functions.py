from pyspark.sql import functions as F

from tidemark.functions.columns import (bool_from_text, range_bin_label, season, table_name_from_file,
                                        uri_segment)


def one(spark, expr, value, typ):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("r")).first()["r"]


def test_range_bin_float_labels(spark):
    lab = lambda v: one(spark, lambda c: range_bin_label(c, 10, True), v, "double")
    assert lab(-3.2) == "-10.0 to -1.0"
    assert lab(9.5) == "10.0 to 19.0"      # half-even: 9.5 -> 10
    assert lab(10.5) == "10.0 to 19.0"     # half-even: 10.5 -> 10
    assert lab(99.6) == "100.0 to 109.0"
    assert lab(-0.4) == "0.0 to 9.0"       # -0.0 normalised
    assert lab(40.0) == "40.0 to 49.0"


def test_range_bin_int_labels(spark):
    assert one(spark, lambda c: range_bin_label(c, 10000, False), 151315, "int") == "150000 to 159999"


def test_table_name_from_file(spark):
    f = lambda v: one(spark, table_name_from_file, v, "string")
    assert f("Daily Nurse-Staffing.Q2.csv") == "daily_nurse_staffing_q2"
    assert f("2024 data.csv") == "table_2024_data"
    assert f("bucket/raw/state_avgs.csv") == "state_avgs"
    assert f(".hidden") == "_hidden"


def test_uri_segment_short_is_null(spark):
    assert one(spark, lambda c: uri_segment(c, 6), "https://a/b", "string") is None
    assert one(spark, lambda c: uri_segment(c, 6), "https://x.io/s/e/i/ID7", "string") == "ID7"


def test_bool_text_and_season(spark):
    assert [one(spark, bool_from_text, v, "string") for v in ("TRUE", "false", "yes", None)] == [True, False, None,
                                                                                                  None]
    assert [one(spark, season, m, "int") for m in (1, 4, 9, 12)] == ["Winter", "Spring", "Summer", "Fall"]
