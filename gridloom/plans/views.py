"""The test tables seen as labelled images, text lines, training logs and parameter tables."""

from pyspark.sql import functions as F

from gridloom.functions import pixels

SIDE = 8
KEYS = ["split", "idx"]
HEADER = ",".join(["label"] + [f"p{i}" for i in range(SIDE * SIDE)])


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def images(spark, sf_dir):
    """`embeddings` as 8x8 byte images; every fifth vector belongs to the test split."""
    return table(spark, sf_dir, "embeddings").select(
        F.when(F.pmod("vec_id", F.lit(5)) == 0, "test").otherwise("train").alias("split"),
        F.col("vec_id").alias("idx"), "label", pixels.to_pixels(F.col("embedding")).alias("px"),
    )


def text_lines(spark, sf_dir):
    """The images as CSV lines, with one header line per label in between (idx below 0)."""
    data = images(spark, sf_dir)
    rows = data.select("idx", F.concat_ws(",", F.col("label"), F.array_join("px", ",")).alias("value"))
    headers = data.groupBy("label").agg(F.min(F.lit(HEADER)).alias("value")).select(
        (F.lit(-1).cast("long") - F.col("label")).alias("idx"), "value"
    )
    return headers.unionByName(rows)


def train_log(spark, sf_dir):
    """`events` as batch records: the event type is the run, the event id the batch number."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run_id"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("rank"),
        F.pmod(F.day("ts"), F.lit(5)).alias("epoch"),
        F.col("event_id").alias("batch_idx"),
        F.lit(64).alias("n_samples"),
        F.pmod(F.col("event_id") * F.lit(7919), F.lit(65)).cast("int").alias("n_correct"),
        F.col("value").alias("loss"),
        "ts",
    )


def params(spark, sf_dir):
    """`embeddings` as tensors: four successive vectors are the four replicas of one tensor."""
    return table(spark, sf_dir, "embeddings").select(
        F.floor(F.col("vec_id") / F.lit(4)).cast("string").alias("name"),
        F.pmod("vec_id", F.lit(4)).cast("int").alias("rank"),
        F.col("embedding").alias("vals"),
    )


IMAGES_SQL = """
img AS (
  SELECT CASE WHEN vec_id % 5 = 0 THEN 'test' ELSE 'train' END AS split, vec_id AS idx, label,
         list_transform(embedding, lambda v:
           CAST(greatest(0, least(255, floor((v::DOUBLE + 1.0::DOUBLE) * 127.5::DOUBLE))) AS INTEGER)) AS px
  FROM embeddings)"""

LINES_SQL = IMAGES_SQL + f""",
lines AS (
  SELECT idx, label || ',' || array_to_string(px, ',') AS value FROM img
  UNION ALL
  SELECT DISTINCT CAST(-1 - label AS BIGINT), '{HEADER}' FROM img)"""

LOG_SQL = """
log AS (
  SELECT event_type AS run_id, CAST(user_id % 4 AS INTEGER) AS rank, CAST(day(ts) % 5 AS INTEGER) AS epoch,
         event_id AS batch_idx, CAST(64 AS INTEGER) AS n_samples,
         CAST(event_id * 7919 % 65 AS INTEGER) AS n_correct, value AS loss, ts
  FROM events)"""
