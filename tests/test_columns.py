import math

import pytest
from pyspark.sql import functions as F

from gridloom.functions import pixels, scores


def one(spark, column, **values):
    """Evaluate a column on one row that holds `values`."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("out")).first().out


def test_quantise_clamps_at_both_ends(spark):
    assert one(spark, pixels.to_pixels(F.col("x")), x=[-2.0, -1.0, 0.0, 0.999, 1.0, 5.0]) == [0, 0, 127, 254, 255, 255]


def test_scaled_pixels_are_float32_quotients(spark):
    import numpy as np

    values = list(range(256))
    got = one(spark, pixels.scale_pixels(F.col("x")), x=values)
    assert got == (np.array(values, np.float32) / np.float32(255)).tolist()
    assert min(got) == 0.0 and max(got) == 1.0


def test_reshape_then_flatten_is_identity(spark):
    x = list(range(24))
    cube = pixels.reshape(F.col("x"), 3, 4, channels=2)
    assert one(spark, cube, x=x)[1][0] == [12, 13, 14, 15]
    assert one(spark, pixels.flatten(cube, 2), x=x) == x


def test_one_hot_then_argmax_is_identity(spark):
    rows = spark.range(10).select("id", pixels.argmax(pixels.one_hot(F.col("id").cast("int"))).alias("back")).collect()
    assert all(r.id == r.back for r in rows)


def test_argmax_takes_the_lowest_place_on_ties(spark):
    assert one(spark, pixels.argmax(F.col("x")), x=[1, 5, 5, 2]) == 1


def test_grid_has_width_three_and_one_line_per_row(spark):
    text = one(spark, pixels.render_grid(F.col("x"), 3), x=[0, 12, 255, 7, 8, 9])
    assert text == "  0  12 255 \n  7   8   9 "


def test_grid_keeps_long_values(spark):
    assert one(spark, pixels.render_grid(F.col("x"), 1), x=[12345]) == "12345 "


def test_version_name(spark):
    got = one(spark, pixels.version_name(F.to_timestamp("t"), "m"), t="2024-02-03 04:05:06")
    assert got == "m_20240203_040506.pth"


def test_activations(spark):
    assert one(spark, scores.relu(F.col("x")), x=[-1.0, 2.0]) == [0.0, 2.0]
    assert one(spark, scores.silu(F.col("x")), x=[2.0]) == pytest.approx([2 / (1 + math.exp(-2))])


def test_round_to_keeps_the_sign_of_zero(spark):
    got = one(spark, F.transform("x", lambda v: scores.round_to(v, 6)), x=[-1e-9, -0.0, 1e-9, 1.0000004, -3.0000006])
    assert [(v, math.copysign(1, v)) for v in got] == [(0.0, -1), (0.0, -1), (0.0, 1), (1.0, 1), (-3.000001, -1)]


def test_cross_entropy_survives_large_scores(spark):
    assert one(spark, scores.cross_entropy(F.col("x"), F.lit(0)), x=[1000.0, 0.0]) == 0.0
    got = one(spark, scores.cross_entropy(F.col("x"), F.lit(1)), x=[1.0, 2.0, 3.0])
    assert got == pytest.approx(math.log(sum(math.exp(v) for v in (1, 2, 3))) - 2)


def test_dropout_is_repeatable_and_keeps_about_half(spark):
    rows = spark.range(200).withColumn("x", F.array_repeat(F.lit(1.0), 50))
    one_run = rows.select("id", scores.dropout(F.col("x"), ["id"], 0.5, 1).alias("y")).orderBy("id").collect()
    again = rows.repartition(7).select("id", scores.dropout(F.col("x"), ["id"], 0.5, 1).alias("y")).orderBy("id").collect()
    other = rows.select("id", scores.dropout(F.col("x"), ["id"], 0.5, 1, epoch=1).alias("y")).orderBy("id").collect()
    assert one_run == again and one_run != other
    cells = [v for r in one_run for v in r.y]
    assert set(cells) == {0.0, 2.0} and 0.45 < cells.count(0.0) / len(cells) < 0.55


def test_batch_norm_applies_fixed_figures(spark):
    stats = [(1.0, 4.0, 1.0, 0.0), (0.0, 1.0, 2.0, 3.0)]
    got = one(spark, scores.batch_norm(F.col("x"), stats, 2, eps=0.0), x=[1.0, 3.0, 1.0, 2.0])
    assert got == pytest.approx([0.0, 1.0, 5.0, 7.0])
