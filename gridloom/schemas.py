"""Row layouts shared by the readers, operators and sinks."""

from pyspark.sql import types as T

TRAIN_LOG = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("rank", T.IntegerType(), False),
    T.StructField("epoch", T.IntegerType(), False),
    T.StructField("batch_idx", T.LongType(), False),
    T.StructField("n_samples", T.IntegerType()),
    T.StructField("n_correct", T.IntegerType()),
    T.StructField("loss", T.DoubleType()),
    T.StructField("ts", T.TimestampType()),
])


def wide_csv(n_pixels, label="label"):
    """Header-row CSV: the label column, then one integer column per pixel."""
    return T.StructType(
        [T.StructField(label, T.IntegerType())]
        + [T.StructField(f"p{i}", T.IntegerType()) for i in range(n_pixels)]
    )
