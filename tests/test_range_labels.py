"""Range labels around zero."""

from pyspark.sql import functions as F

from hearth.functions import bins, text


def test_a_negative_zero_keeps_its_sign(spark):
    rows = spark.createDataFrame([(0, -0.0), (1, 0.0), (2, -0.3), (3, 0.3), (4, 1.0)], "n int, x double")
    found = rows.select("n", text.half_range_label(F.col("x")), bins.half_floor(F.col("x")).cast("string")).orderBy("n").collect()
    assert [tuple(row)[1:] for row in found] == [
        ("-0...0.5", "-0.0"), ("0...0.5", "0.0"), ("-0.5...0", "-0.5"), ("0...0.5", "0.0"), ("1...1.5", "1.0")
    ]
