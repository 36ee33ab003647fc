"""Registered queries over images and text lines, each with the SQL that must give the same rows."""

import numpy as np
from pyspark.sql import functions as F

from gridloom.functions import pixels, scores
from gridloom.operators import layers, metrics, ordering, pairing
from gridloom.plans.views import HEADER, IMAGES_SQL, KEYS, LINES_SQL, SIDE, images, table, text_lines
from gridloom.sources import tables
from gridloom.training import model
from gridloom.training.arch import Arch, arch, param_shapes

N = SIDE * SIDE
KERNEL = [[1, 2, -1], [0, 3, -2], [2, -1, 1]]
BIAS = 7
SEED = 42

QUERIES, ORACLE = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


# --- projections and array functions -------------------------------------------------------------------------

@query("q_pixels", f"WITH {IMAGES_SQL} SELECT * FROM img")
def q_pixels(spark, sf):
    return images(spark, sf)


@query("q_label_projection", f"WITH {IMAGES_SQL} SELECT label FROM img")
def q_label_projection(spark, sf):
    return tables.labels(images(spark, sf))


@query("q_feature_projection", f"WITH {IMAGES_SQL} SELECT split, idx, px FROM img")
def q_feature_projection(spark, sf):
    return tables.features(images(spark, sf))


@query("q_scale_pixels", f"""WITH {IMAGES_SQL}
SELECT idx, list_transform(px, lambda v: CAST(v / 255.0::DOUBLE AS FLOAT)) AS x FROM img""")
def q_scale_pixels(spark, sf):
    return images(spark, sf).select("idx", pixels.scale_pixels(F.col("px")).alias("x"))


@query("q_reshape_rows", f"""WITH {IMAGES_SQL}
SELECT idx, CAST(r AS INTEGER) AS image_row, px[r * {SIDE} + 1 : r * {SIDE} + {SIDE}] AS cells
FROM img, range({SIDE}) t(r)""")
def q_reshape_rows(spark, sf):
    rows = pixels.reshape_rows(F.col("px"), SIDE, SIDE)
    return images(spark, sf).select("idx", F.posexplode(rows).alias("image_row", "cells"))


@query("q_flatten_roundtrip", f"WITH {IMAGES_SQL} SELECT idx, px AS flat, TRUE AS same FROM img")
def q_flatten_roundtrip(spark, sf):
    cube = pixels.reshape(F.col("px"), SIDE // 2, SIDE, channels=2)
    flat = images(spark, sf).withColumn("flat", pixels.flatten(cube, depth=2))
    return flat.select("idx", "flat", (F.col("flat") == F.col("px")).alias("same"))


@query("q_one_hot", f"""WITH {IMAGES_SQL}
SELECT idx, list_transform(range(10), lambda i: CAST(CASE WHEN i = label THEN 1 ELSE 0 END AS FLOAT)) AS hot,
       label AS decoded FROM img""")
def q_one_hot(spark, sf):
    hot = images(spark, sf).withColumn("hot", pixels.one_hot(F.col("label")))
    return hot.select("idx", "hot", pixels.argmax(F.col("hot")).alias("decoded"))


@query("q_argmax", f"""WITH {IMAGES_SQL}
SELECT idx, CAST(list_position(px, list_max(px)) - 1 AS INTEGER) AS brightest FROM img""")
def q_argmax(spark, sf):
    return images(spark, sf).select("idx", pixels.argmax(F.col("px")).alias("brightest"))


@query("q_render_grid", f"""WITH {IMAGES_SQL},
cells AS (SELECT idx, list_transform(px, lambda v: lpad(CAST(v AS VARCHAR), 3, ' ') || ' ') AS c FROM img)
SELECT idx, array_to_string(list_transform(range({SIDE}), lambda r:
         array_to_string(c[r * {SIDE} + 1 : r * {SIDE} + {SIDE}], '')), chr(10)) AS grid FROM cells""")
def q_render_grid(spark, sf):
    return images(spark, sf).select("idx", pixels.render_grid(F.col("px"), SIDE).alias("grid"))


# --- sources -------------------------------------------------------------------------------------------------

@query("q_preview_first_n", f"WITH {IMAGES_SQL} SELECT * FROM img ORDER BY split, idx LIMIT 5")
def q_preview_first_n(spark, sf):
    return tables.preview(images(spark, sf), KEYS, 5)


@query("q_csv_wide_pack", f"WITH {IMAGES_SQL} SELECT label, px FROM img")
def q_csv_wide_pack(spark, sf):
    wide = images(spark, sf).select("label", *[F.get("px", F.lit(i)).alias(f"p{i}") for i in range(N)])
    return tables.pack_wide(wide)


@query("q_text_parse", f"WITH {IMAGES_SQL} SELECT idx, label, px FROM img")
def q_text_parse(spark, sf):
    lines = tables.drop_header_equal(text_lines(spark, sf), HEADER)
    return tables.parse_labeled_lines(lines, n_pixels=N)


@query("q_text_parse_quarantine", f"""WITH {LINES_SQL}
SELECT l.idx, i.label, i.px, CASE WHEN i.idx IS NULL THEN 'label' END AS error,
       CASE WHEN i.idx IS NULL THEN l.value END AS bad_line
FROM lines l LEFT JOIN img i ON l.idx = i.idx""")
def q_text_parse_quarantine(spark, sf):
    return tables.parse_labeled_lines(text_lines(spark, sf), n_pixels=N, mode="quarantine")


@query("q_header_first_line", f"WITH {LINES_SQL} SELECT idx, value FROM lines WHERE value <> '{HEADER}'")
def q_header_first_line(spark, sf):
    return tables.drop_header_equal(text_lines(spark, sf), HEADER)


@query("q_header_contains", f"WITH {LINES_SQL} SELECT idx, value FROM lines WHERE NOT contains(value, 'label')")
def q_header_contains(spark, sf):
    return tables.drop_header_containing(text_lines(spark, sf))


@query("q_text_parse_lineitem", """
SELECT l_linenumber AS label, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS sum_0,
       CAST(sum(l_suppkey) AS BIGINT) AS sum_1, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS sum_2
FROM lineitem GROUP BY l_linenumber""")
def q_text_parse_lineitem(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.concat_ws(",", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int")).alias("value")
    )
    parsed = tables.parse_labeled_lines(lines, n_pixels=3)
    return parsed.groupBy("label").agg(
        F.count("*").alias("n"), *[F.sum(F.get("px", F.lit(i))).alias(f"sum_{i}") for i in range(3)]
    )


# --- pairing -------------------------------------------------------------------------------------------------

@query("q_pair_by_position", f"WITH {IMAGES_SQL} SELECT split, idx, px, label FROM img")
def q_pair_by_position(spark, sf):
    data = images(spark, sf)
    return pairing.pair_by_position(data.select(*KEYS, "px"), data.select(*KEYS, "label"))


@query("q_pair_orders", """
SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY ALL""")
def q_pair_orders(spark, sf):
    data = table(spark, sf, "orders")
    paired = pairing.pair_by_position(
        data.select("o_orderkey", "o_orderstatus"), data.select("o_orderkey", "o_orderpriority"), ["o_orderkey"]
    )
    return paired.groupBy(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).agg(
        F.count("*").alias("n")
    )


# --- histograms and shapes -----------------------------------------------------------------------------------

@query("q_label_histogram", f"WITH {IMAGES_SQL} SELECT label, count(*) AS n FROM img GROUP BY label")
def q_label_histogram(spark, sf):
    return metrics.label_histogram(images(spark, sf))


@query("q_histogram_lineitem", "SELECT l_linenumber AS label, count(*) AS n FROM lineitem GROUP BY l_linenumber")
def q_histogram_lineitem(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("label"))
    return metrics.label_histogram(lines)


@query("q_label_histogram_binary", "SELECT quality, count(*) AS n FROM labels GROUP BY quality")
def q_label_histogram_binary(spark, sf):
    return metrics.label_histogram(table(spark, sf, "labels"), "quality")


@query("q_split_summary", f"""WITH {IMAGES_SQL}
SELECT split, count(*) AS n_rows, CAST(min(len(px)) AS INTEGER) AS min_size,
       CAST(max(len(px)) AS INTEGER) AS max_size, count(DISTINCT label) AS n_labels FROM img GROUP BY split""")
def q_split_summary(spark, sf):
    return metrics.split_summary(images(spark, sf))


# --- sampling, shuffling, sharding, batching -----------------------------------------------------------------

def _placed_sql(source, key, seed=SEED, epoch=0):
    digest = f"md5('{seed}:{epoch}:' || " + " || ':' || ".join(f"CAST({k} AS VARCHAR)" for k in key) + ")"
    return f"""placed AS (
  SELECT *, row_number() OVER (ORDER BY {digest}, {', '.join(key)}) - 1 AS p, count(*) OVER () AS n FROM {source})"""


def _shard_sql(world):
    return f"""sharded AS (
  SELECT placed.* EXCLUDE (p, n), CAST(q AS BIGINT) AS pos, q >= n AS is_padding, CAST(q % {world} AS INTEGER) AS rank,
         CAST(q // {world} AS BIGINT) AS pos_in_rank
  FROM placed, LATERAL (SELECT unnest(range(p, CAST(ceil(n / {world}.0) AS BIGINT) * {world}, n)) AS q))"""


@query("q_sample_k", f"""WITH {IMAGES_SQL}, {_placed_sql('img', KEYS)}
SELECT split, idx, label, px FROM placed WHERE p < 10""")
def q_sample_k(spark, sf):
    return ordering.sample_k(images(spark, sf), KEYS, 10, SEED)


@query("q_epoch_order", f"""WITH {IMAGES_SQL}, {_placed_sql('img', KEYS, epoch=3)}
SELECT split, idx, p AS pos, n AS n_rows FROM placed""")
def q_epoch_order(spark, sf):
    return ordering.epoch_order(images(spark, sf).select(*KEYS), KEYS, SEED, 3, total="n_rows")


@query("q_shard", f"WITH {IMAGES_SQL}, {_placed_sql('img', KEYS)}, {_shard_sql(6)} SELECT * FROM sharded")
def q_shard(spark, sf):
    return ordering.shard(images(spark, sf), KEYS, 6, SEED)


@query("q_shard_replicate", f"""WITH {IMAGES_SQL}, {_placed_sql('img', KEYS)}
SELECT idx, split, p AS pos, CAST(r AS INTEGER) AS rank, p AS pos_in_rank, FALSE AS is_padding
FROM placed, range(3) t(r)""")
def q_shard_replicate(spark, sf):
    return ordering.shard(images(spark, sf).select(*KEYS), KEYS, 3, SEED, mode="replicate")


@query("q_minibatch", f"""WITH {IMAGES_SQL}, {_placed_sql('img', KEYS)}, {_shard_sql(4)}
SELECT split, idx, rank, pos_in_rank // 64 AS batch_idx, CAST(pos_in_rank % 64 AS INTEGER) AS slot FROM sharded""")
def q_minibatch(spark, sf):
    dealt = ordering.shard(images(spark, sf).select(*KEYS), KEYS, 4, SEED)
    return ordering.minibatch(dealt, 64).select(*KEYS, "rank", "batch_idx", "slot")


@query("q_shard_orders", f"""WITH {_placed_sql('orders', ['o_orderkey'])}, {_shard_sql(7)}
SELECT o_orderkey, o_totalprice, pos, rank, pos_in_rank, is_padding FROM sharded""")
def q_shard_orders(spark, sf):
    data = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ordering.shard(data, ["o_orderkey"], 7, SEED)


@query("q_minibatch_orders", f"""WITH {_placed_sql('orders', ['o_orderkey'])}, {_shard_sql(8)}
SELECT rank, pos_in_rank // 128 AS batch_idx, count(*) AS n_samples,
       CAST(sum(o_custkey) AS BIGINT) AS key_sum FROM sharded GROUP BY ALL""")
def q_minibatch_orders(spark, sf):
    data = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    dealt = ordering.minibatch(ordering.shard(data, ["o_orderkey"], 8, SEED), 128)
    return dealt.groupBy("rank", "batch_idx").agg(
        F.count("*").alias("n_samples"), F.sum("o_custkey").alias("key_sum")
    )


# --- layers --------------------------------------------------------------------------------------------------

def _conv_sql(pad):
    side = SIDE + 2 * pad - 2
    terms = [
        f"{KERNEL[i][j]} * coalesce(CASE WHEN r + {i - pad} BETWEEN 0 AND {SIDE - 1} AND c + {j - pad} BETWEEN 0 AND "
        f"{SIDE - 1} THEN px[(r + {i - pad}) * {SIDE} + c + {j - pad} + 1] END, 0)"
        for i in range(3) for j in range(3)
    ]
    return f"""WITH {IMAGES_SQL},
cells AS (SELECT idx, r * {side} + c AS place, CAST({' + '.join(terms)} + {BIAS} AS BIGINT) AS v
          FROM img, range({side}) a(r), range({side}) b(c))
SELECT idx, list(v ORDER BY place) AS conv FROM cells GROUP BY idx"""


@query("q_conv2d", _conv_sql(0))
def q_conv2d(spark, sf):
    return layers.conv2d(images(spark, sf).select("idx", "px"), [[KERNEL]], [BIAS], SIDE, SIDE).drop("px")


@query("q_conv2d_padded", _conv_sql(1))
def q_conv2d_padded(spark, sf):
    return layers.conv2d(images(spark, sf).select("idx", "px"), [[KERNEL]], [BIAS], SIDE, SIDE, pad=1).drop("px")


def _pool_sql(height, width):
    """Pooling of the first height x width pixels read as one image."""
    oh, ow = height // 2, width // 2
    at = f"(2 * (p // {ow})) * {width} + 2 * (p % {ow})"
    return f"""list_transform(range({oh * ow}), lambda p: greatest(
      px[{at} + 1], px[{at} + 2], px[{at} + {width} + 1], px[{at} + {width} + 2]))"""


@query("q_max_pool", f"""WITH {IMAGES_SQL}
SELECT idx, {_pool_sql(8, 8)} AS pooled, {_pool_sql(7, 9)} AS pooled_odd FROM img""")
def q_max_pool(spark, sf):
    even = layers.max_pool2d(images(spark, sf).select("idx", "px"), SIDE, SIDE)
    odd = even.withColumn("px", F.slice("px", 1, 63))
    return layers.max_pool2d(odd, 7, 9, out="pooled_odd").drop("px")


WEIGHTS = [[(3 * i + 7 * j) % 11 - 5 for j in range(N)] for i in range(10)]
DENSE_SQL = ", ".join(
    f"CAST({i} + list_sum(list_transform(range({N}), lambda j: px[j + 1] * ((3 * {i} + 7 * j) % 11 - 5))) AS BIGINT)"
    for i in range(10)
)


@query("q_dense", f"WITH {IMAGES_SQL} SELECT idx, [{DENSE_SQL}] AS dense FROM img")
def q_dense(spark, sf):
    return layers.dense(images(spark, sf).select("idx", "px"), WEIGHTS, list(range(10))).drop("px")


@query("q_activation", """
SELECT vec_id AS idx, list_transform(embedding, lambda v: greatest(v::DOUBLE, 0.0::DOUBLE)) AS relu,
       list_transform(embedding, lambda v: round(v::DOUBLE / (1.0::DOUBLE + exp(-(v::DOUBLE))), 6)) AS silu
FROM embeddings""")
def q_activation(spark, sf):
    x = F.transform("embedding", lambda v: v.cast("double"))
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("idx"), scores.relu(x).alias("relu"),
        F.transform(scores.silu(x), lambda v: scores.round_to(v, 6)).alias("silu"),
    )


STATS_SQL = f"""stats AS (
  SELECT CAST(j // 16 AS INTEGER) AS channel, avg(v::DOUBLE) AS mean,
         sum(v::DOUBLE * v) / count(*) - avg(v::DOUBLE) * avg(v::DOUBLE) AS variance
  FROM (SELECT unnest(px) AS v, unnest(range({N})) AS j FROM img) GROUP BY 1)"""


@query("q_batch_norm_stats", f"""WITH {IMAGES_SQL}, {STATS_SQL}
SELECT channel, round(mean, 6) AS mean, round(variance, 6) AS variance FROM stats""")
def q_batch_norm_stats(spark, sf):
    x = images(spark, sf).select(F.transform("px", lambda v: v.cast("double")).alias("x"))
    return layers.batch_norm_fit(x, 4, 16).select(
        "channel", F.round("mean", 6).alias("mean"), F.round("variance", 6).alias("variance")
    )


@query("q_batch_norm", f"""WITH {IMAGES_SQL}, {STATS_SQL},
cells AS (SELECT idx, unnest(px) AS v, unnest(range({N})) AS j FROM img)
SELECT idx, list(round((v - mean) / sqrt(variance + 1e-5::DOUBLE) * (channel + 1) + 0.5::DOUBLE, 6) ORDER BY j)
  AS normalised
FROM cells JOIN stats ON stats.channel = j // 16 GROUP BY idx""")
def q_batch_norm(spark, sf):
    data = images(spark, sf).select("idx", F.transform("px", lambda v: v.cast("double")).alias("x"))
    fitted = sorted(layers.batch_norm_fit(data, 4, 16).collect(), key=lambda r: r.channel)
    stats = [(r["mean"], r.variance, r.channel + 1.0, 0.5) for r in fitted]
    normalised = scores.batch_norm(F.col("x"), stats, 16)
    return data.select("idx", F.transform(normalised, lambda v: F.round(v, 6)).alias("normalised"))


@query("q_dropout", f"""WITH {IMAGES_SQL}
SELECT idx, list_transform(range({N}), lambda j: CASE
  WHEN CAST('0x' || md5('{SEED}:2:' || split || ':' || idx || ':' || j)[1:8] AS BIGINT) / 4294967296.0::DOUBLE < 0.5
  THEN 0.0::DOUBLE ELSE px[j + 1] / 0.5::DOUBLE END) AS dropped FROM img""")
def q_dropout(spark, sf):
    x = F.transform("px", lambda v: v.cast("double"))
    return images(spark, sf).select("idx", scores.dropout(x, KEYS, 0.5, SEED, epoch=2).alias("dropped"))


@query("q_cross_entropy", """
WITH t AS (SELECT vec_id // 64 AS batch_idx, label, list_transform(embedding, lambda v: v::DOUBLE * 10) AS s
           FROM embeddings)
SELECT batch_idx, count(*) AS n_samples,
       round(avg(ln(list_sum(list_transform(s, lambda v: exp(v - list_max(s))))) + list_max(s) - s[label + 1]), 6) AS loss
FROM t GROUP BY batch_idx""")
def q_cross_entropy(spark, sf):
    s = F.transform("embedding", lambda v: v.cast("double") * 10)
    rows = table(spark, sf, "embeddings").select(
        F.floor(F.col("vec_id") / 64).alias("batch_idx"), scores.cross_entropy(s, F.col("label")).alias("loss")
    )
    return rows.groupBy("batch_idx").agg(
        F.count("*").alias("n_samples"), F.round(F.avg("loss"), 6).alias("loss")
    )


# --- prediction with class means, accuracy, confusion --------------------------------------------------------

def predict_template(spark, sf):
    """Nearest class mean in whole numbers: the smallest |x - t|^2 is the largest 2 t.x - |t|^2, a dense layer.

    The means are those of the train split, a class without a train row has mean 0. Only the model (classes x pixels) comes to the driver.
    """
    data = images(spark, sf)
    means = np.zeros((10, N), np.int64)
    for r in layers.class_sums(data.filter("split = 'train'")).collect():
        means[r.label, r.pos] = r.total // r.n
    net = Arch((("flatten",), ("dense", "fc", 10)), SIDE, SIDE)
    params = {"fc.weight": 2.0 * means, "fc.bias": -(means ** 2).sum(axis=1).astype(float)}
    return model.predict(data, net, params, denom=1.0, element="double")


PREDICT_SQL = f"""{IMAGES_SQL},
cells AS (SELECT split, idx, label, unnest(px) AS v, unnest(range({N})) AS j FROM img),
seen AS (SELECT label, j, sum(v) // count(*) AS t FROM cells WHERE split = 'train' GROUP BY 1, 2),
template AS (SELECT c.range AS c, j.range AS j, coalesce(t, 0) AS t
             FROM range(10) c CROSS JOIN range({N}) j LEFT JOIN seen ON seen.label = c.range AND seen.j = j.range),
score AS (SELECT idx, c, CAST(sum(2 * t * v - t * t) AS BIGINT) AS s FROM cells JOIN template USING (j) GROUP BY 1, 2),
best AS (SELECT idx, arg_max(c, s * 100 - c) AS pred FROM score GROUP BY idx),
predicted AS (SELECT img.*, pred FROM img JOIN best USING (idx))"""

GRID_SQL = "(SELECT a.range AS truth, b.range AS predicted FROM range(10) a, range(10) b)"


@query("q_predict_template", f"WITH {PREDICT_SQL} SELECT split, idx, label, pred FROM predicted")
def q_predict_template(spark, sf):
    return predict_template(spark, sf).select(*KEYS, "label", "pred")


CNN_WEIGHT = "((5 * k.range + 3 * place) % 7 - 3)"


def _cnn_sql():
    """Two filters (the kernel, and the kernel plus one), ReLU, pooling, dense layer, arg-max."""
    terms = " + ".join(
        f"({KERNEL[i][j]} + f.range) * px[(r.range + {i}) * {SIDE} + c.range + {j + 1}]" for i in range(3) for j in range(3)
    )
    return f"""WITH {IMAGES_SQL},
conv AS (SELECT idx, f.range AS f, r.range AS r, c.range AS c, greatest(0, {terms} - 300) AS v
         FROM img, range(2) f, range({SIDE - 2}) r, range({SIDE - 2}) c),
pooled AS (SELECT idx, f * 9 + (r // 2) * 3 + c // 2 AS place, max(v) AS v FROM conv GROUP BY 1, 2),
score AS (SELECT idx, k.range AS c, CAST(sum(v * {CNN_WEIGHT}) AS BIGINT) AS s FROM pooled, range(10) k GROUP BY 1, 2)
SELECT idx, CAST(arg_max(c, s * 100 - c) AS INTEGER) AS pred, list(s::DOUBLE ORDER BY c) AS scores FROM score GROUP BY idx"""


@query("q_predict_cnn", _cnn_sql())
def q_predict_cnn(spark, sf):
    """A small network with whole-number weights, so that every score is exact."""
    net = Arch((
        ("conv", "conv", 2, 0), ("relu",), ("pool",), ("flatten",), ("dense", "fc", 10),
    ), SIDE, SIDE)
    params = {
        "conv.weight": np.array([[KERNEL], [np.array(KERNEL) + 1]], float), "conv.bias": np.full(2, -300.0),
        "fc.weight": np.array([[(5 * c + 3 * k) % 7 - 3 for k in range(18)] for c in range(10)], float),
        "fc.bias": np.zeros(10),
    }
    predicted = model.predict(images(spark, sf).select("idx", "px"), net, params, denom=1.0, element="double")
    return predicted.select("idx", "pred", "scores")


def _layout_a_weights(shapes):
    """Small whole numbers by a rule of their places; LAYOUT_A_SQL states the same rules."""
    rules = {
        "conv1.weight": lambda f, _, i, j: (f + 3 * i + 5 * j) % 5 - 2, "conv1.bias": lambda f: f - 40,
        "fc1.weight": lambda o, k: (3 * o + 5 * k) % 7 - 3, "fc1.bias": lambda o: 10 * o,
        "fc2.weight": lambda c, o: (5 * c + 3 * o) % 7 - 3, "fc2.bias": lambda c: c,
    }
    return {name: np.fromfunction(np.vectorize(rules[name], otypes=[float]), shape, dtype=int) for name, shape, _ in shapes}


def _layout_a_sql():
    """32 filters, ReLU, pooling, 128 units, ReLU, 10 scores, arg-max."""
    terms = " + ".join(
        f"((f.range + {3 * i + 5 * j}) % 5 - 2) * px[(r.range + {i}) * {SIDE} + c.range + {j + 1}]" for i in range(3) for j in range(3))
    half = (SIDE - 2) // 2
    return f"""WITH {IMAGES_SQL},
conv AS (SELECT idx, f.range AS f, r.range AS r, c.range AS c, greatest(0, {terms} + f.range - 40) AS v
         FROM img, range(32) f, range({SIDE - 2}) r, range({SIDE - 2}) c),
pooled AS (SELECT idx, f * {half * half} + (r // 2) * {half} + c // 2 AS k, max(v) AS v FROM conv GROUP BY 1, 2),
flat AS (SELECT idx, list(v::DOUBLE ORDER BY k) AS x FROM pooled GROUP BY idx),
hidden AS (SELECT idx, o.range AS o, greatest(0, list_dot_product(x, list_transform(range({32 * half * half}), lambda k: ((3 * o.range + 5 * k) % 7 - 3)::DOUBLE)) + 10 * o.range) AS v
           FROM flat, range(128) o),
score AS (SELECT idx, c.range AS c, sum(v * ((5 * c.range + 3 * o) % 7 - 3)) + c.range AS s FROM hidden, range(10) c GROUP BY 1, 2)
SELECT idx, CAST(arg_max(c, s * 100 - c) AS INTEGER) AS pred, list(s::DOUBLE ORDER BY c) AS scores FROM score GROUP BY idx"""


@query("q_predict_layout_a", _layout_a_sql())
def q_predict_layout_a(spark, sf):
    """The named layout A with whole-number weights, so that every score is exact."""
    net = arch("A", SIDE, SIDE)
    params = _layout_a_weights(param_shapes(net))
    return model.predict(images(spark, sf).select("idx", "px"), net, params, denom=1.0, element="double").select("idx", "pred", "scores")


@query("q_class_sums", f"""WITH {IMAGES_SQL}, cells AS (SELECT label, unnest(px) AS v, unnest(range({N})) AS j FROM img)
SELECT label, CAST(j AS INTEGER) AS pos, CAST(sum(v) AS BIGINT) AS total, count(*) AS n FROM cells GROUP BY 1, 2""")
def q_class_sums(spark, sf):
    return layers.class_sums(images(spark, sf))


@query("q_accuracy", f"""WITH {PREDICT_SQL}
SELECT split, count(*) AS n_rows, CAST(sum(CAST(label = pred AS INTEGER)) AS BIGINT) AS n_correct,
       round(100.0::DOUBLE * sum(CAST(label = pred AS INTEGER)) / count(*), 6) AS accuracy
FROM predicted GROUP BY split""")
def q_accuracy(spark, sf):
    out = metrics.accuracy(predict_template(spark, sf), "percent", ["split"])
    return out.withColumn("accuracy", F.round("accuracy", 6))


@query("q_accuracy_fraction", f"""WITH {PREDICT_SQL}
SELECT label, count(*) AS n_rows, CAST(sum(CAST(label = pred AS INTEGER)) AS BIGINT) AS n_correct,
       round(sum(CAST(label = pred AS INTEGER))::DOUBLE / count(*), 6) AS accuracy
FROM predicted GROUP BY label""")
def q_accuracy_fraction(spark, sf):
    out = metrics.accuracy(predict_template(spark, sf), "fraction", ["label"])
    return out.withColumn("accuracy", F.round("accuracy", 6))


@query("q_confusion_matrix", f"""WITH {PREDICT_SQL}
SELECT CAST(g.truth AS INTEGER) AS truth, CAST(g.predicted AS INTEGER) AS predicted, count(p.idx) AS n
FROM {GRID_SQL} g LEFT JOIN predicted p ON p.label = g.truth AND p.pred = g.predicted GROUP BY ALL""")
def q_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(predict_template(spark, sf))


@query("q_confusion_pivot", f"""WITH {PREDICT_SQL}
SELECT label AS truth, {', '.join(f'count(*) FILTER (pred = {c}) AS predicted_{c}' for c in range(10))}
FROM predicted GROUP BY label""")
def q_confusion_pivot(spark, sf):
    return metrics.confusion_matrix(predict_template(spark, sf), pivot=True)


@query("q_evaluate", f"""WITH {PREDICT_SQL},
totals AS (SELECT split, count(*) AS n_rows, round(100.0::DOUBLE * sum(CAST(label = pred AS INTEGER)) / count(*), 6)
           AS accuracy, count(*) FILTER (label NOT BETWEEN 0 AND 9 OR pred NOT BETWEEN 0 AND 9) AS n_outside
           FROM predicted GROUP BY split)
SELECT t.split, CAST(g.truth AS INTEGER) AS truth, CAST(g.predicted AS INTEGER) AS predicted, count(p.idx) AS n,
       t.n_rows, t.accuracy, t.n_outside
FROM totals t CROSS JOIN {GRID_SQL} g
LEFT JOIN predicted p ON p.split = t.split AND p.label = g.truth AND p.pred = g.predicted GROUP BY ALL""")
def q_evaluate(spark, sf):
    return model.evaluate(predict_template(spark, sf)).withColumn("accuracy", F.round("accuracy", 6))


@query("q_confusion_quality_toxic", """
SELECT CAST(a.range AS INTEGER) AS truth, CAST(b.range AS INTEGER) AS predicted, count(l.doc_id) AS n
FROM range(2) a CROSS JOIN range(2) b LEFT JOIN labels l ON l.quality = a.range AND l.toxic = b.range GROUP BY ALL""")
def q_confusion_quality_toxic(spark, sf):
    return metrics.confusion_matrix(table(spark, sf, "labels"), 2, label="quality", predicted="toxic")
