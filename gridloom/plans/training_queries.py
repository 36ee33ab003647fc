"""Registered training queries.

A long run depends on floating-point details and has no SQL twin; single steps and a short epoch do. The first step from zero parameters is the simplest: with
equal scores its gradient is a plain mean over all rows. Its weights are multiples of 1 / (255 n), which never fall half-way
between two numbers of four decimals for the row counts n of the test tables.
"""

import numpy as np
from pyspark.sql import functions as F

from gridloom.operators import metrics
from gridloom.plans.views import IMAGES_SQL, SIDE, images
from gridloom.training import arch, fit, model

QUERIES, ORACLE = {}, {}
N = SIDE * SIDE


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


FIRST_STEP_SQL = f"""WITH {IMAGES_SQL},
cells AS (SELECT label, unnest(px) / 255.0::DOUBLE AS v, unnest(range({N})) AS pos FROM img)
SELECT CAST(c.range AS INTEGER) AS class, CAST(pos AS INTEGER) AS pos,
       round(-10.0::DOUBLE * avg((0.1::DOUBLE - CAST(label = c.range AS INTEGER)) * v), 4) + 0.0::DOUBLE AS weight
FROM cells, range(10) c GROUP BY 1, 2"""


def _first_step(spark, sf, sync):
    """Four ranks, one batch each, from zero parameters with learning rate 10."""
    net = arch.arch("softmax", SIDE, SIDE)
    zeros = {name: np.zeros(shape, np.float32) for name, shape, _ in arch.param_shapes(net)}
    done = fit.fit(
        images(spark, sf), net, world=4, batch=1 << 30, opt=arch.sgd(lr=10.0, momentum=0.0), params=zeros, sync=sync
    )
    return _weights(spark, done, 4)


for _sync in ("epoch", "step"):
    QUERIES[f"q_fit_first_step_{_sync}"] = lambda spark, sf, sync=_sync: _first_step(spark, sf, sync)
    ORACLE[f"q_fit_first_step_{_sync}"] = FIRST_STEP_SQL


def _weights(spark, done, places):
    weights = [(c, p, float(w)) for (c, p), w in np.ndenumerate(done.params["fc.weight"])]
    table = spark.createDataFrame(weights, "class int, pos int, weight double")
    return table.withColumn("weight", F.round("weight", places) + 0.0)


def _from_zero(spark, sf, **options):
    """One worker, all rows in one batch, from zero parameters."""
    net = arch.arch("softmax", SIDE, SIDE)
    zeros = {name: np.zeros(shape, np.float32) for name, shape, _ in arch.param_shapes(net)}
    return fit.fit(images(spark, sf), net, world=1, batch=1 << 30, params=zeros, **options)


FIRST_GRADIENT_SQL = f"""{IMAGES_SQL},
cells AS (SELECT idx, label, unnest(px) / 255.0::DOUBLE AS v, unnest(range({N})) AS j FROM img),
rows AS (SELECT idx, label FROM img),
g1 AS (SELECT c.range AS c, j, avg((0.1::DOUBLE - CAST(label = c.range AS INTEGER)) * v) AS g FROM cells, range(10) c GROUP BY 1, 2),
b1 AS (SELECT c.range AS c, avg(0.1::DOUBLE - CAST(label = c.range AS INTEGER)) AS g FROM rows, range(10) c GROUP BY 1)"""

#: Second step: v = 0.9 v + gradient + 0.01 w, w = w - 2 v, where the first step left w = -2 g1.
MOMENTUM_SQL = f"""WITH {FIRST_GRADIENT_SQL},
score AS (SELECT idx, label, g1.c, sum(-2 * g1.g * v) + any_value(-2 * b1.g) AS s FROM cells JOIN g1 USING (j) JOIN b1 ON b1.c = g1.c GROUP BY 1, 2, 3),
top AS (SELECT idx, ln(sum(exp(s))) AS z FROM score GROUP BY idx),
off AS (SELECT idx, c, exp(s - z) - CAST(label = c AS INTEGER) AS d FROM score JOIN top USING (idx)),
g2 AS (SELECT c, j, avg(d * v) AS g FROM off JOIN cells USING (idx) GROUP BY 1, 2)
SELECT CAST(c AS INTEGER) AS class, CAST(j AS INTEGER) AS pos,
       round(-2 * g1.g - 2 * (0.9::DOUBLE * g1.g + g2.g + 0.01::DOUBLE * -2 * g1.g), 3) + 0.0::DOUBLE AS weight
FROM g1 JOIN g2 USING (c, j)"""

#: Without a history the mean and the square of the gradient are the gradient itself.
ADAM_SQL = f"""WITH {FIRST_GRADIENT_SQL}
SELECT CAST(c AS INTEGER) AS class, CAST(j AS INTEGER) AS pos, round(-0.25::DOUBLE * g / (abs(g) + 1e-8::DOUBLE), 3) + 0.0::DOUBLE AS weight
FROM g1"""


@query
def q_fit_momentum(spark, sf):
    """Two full-batch steps with momentum and weight decay."""
    opt = arch.sgd(lr=2.0, momentum=0.9, weight_decay=0.01)
    return _weights(spark, _from_zero(spark, sf, epochs=2, opt=opt), 3)


@query
def q_fit_adam(spark, sf):
    return _weights(spark, _from_zero(spark, sf, opt=arch.adam(lr=0.25)), 3)


ORACLE |= {"q_fit_momentum": MOMENTUM_SQL, "q_fit_adam": ADAM_SQL}


def _log(result):
    return result.log.drop("run_id", "ts").withColumn("loss", F.round("loss", 4))


@query
def q_fit_softmax(spark, sf):
    """Four ranks, two epochs, parameters averaged once per epoch."""
    return _log(fit.fit(images(spark, sf), arch.arch("softmax", SIDE, SIDE), world=4, epochs=2))


@query
def q_fit_step_sync(spark, sf):
    """Two ranks that average gradients at every step."""
    return _log(fit.fit(images(spark, sf), arch.arch("B", SIDE, SIDE), world=2, sync="step"))


@query
def q_fit_then_evaluate(spark, sf):
    """Three convolutions with batch-norm and dropout, then confusion counts per split."""
    data, net = images(spark, sf), arch.arch("D", SIDE, SIDE)
    trained = fit.fit(data.filter("split = 'train'"), net, world=4)
    return model.evaluate(model.predict(data, net, trained.params))


@query
def q_featurize_fit_head(spark, sf):
    """Frozen convolutions, then a trained last layer; predictions of the head per split and class."""
    data, net = images(spark, sf), arch.arch("C", SIDE, SIDE)
    frozen = arch.init_params(net)
    upto = [layer[0] for layer in net.layers].index("flatten") + 1
    head, trained = fit.fit_head(data.filter("split = 'train'"), net, frozen, upto, world=2)
    features = model.featurize(data, net, frozen, upto)
    predicted = model.predict(features, head, trained.params, source="features", denom=1.0)
    return metrics.label_histogram(predicted, "pred")


FROZEN = arch.Arch((("conv", "conv", 2, 0), ("relu",), ("pool",), ("flatten",), ("dense", "fc", 10)), SIDE, SIDE)


def _frozen():
    """Whole numbers, so that the features are exact; FEATURES_SQL states the same."""
    filters = np.array([[[[(f + 3 * i + 5 * j) % 5 - 2 for j in range(3)] for i in range(3)]] for f in range(2)], np.float32)
    zeros = {name: np.zeros(shape, np.float32) for name, shape, _ in arch.param_shapes(FROZEN)}
    return zeros | {"conv.weight": filters, "conv.bias": np.full(2, -100, np.float32)}


def _conv_terms(px="px"):
    return " + ".join(
        f"((f.range + {3 * i + 5 * j}) % 5 - 2) * {px}[(r.range + {i}) * {SIDE} + c.range + {j + 1}]" for i in range(3) for j in range(3))


FEATURES_SQL = f"""{IMAGES_SQL},
conv AS (SELECT idx, label, f.range AS f, r.range AS r, c.range AS c, greatest(0, {_conv_terms()} - 100) AS v
         FROM img, range(2) f, range({SIDE - 2}) r, range({SIDE - 2}) c),
feature AS (SELECT idx, label, f * {(SIDE // 2 - 1) ** 2} + (r // 2) * {SIDE // 2 - 1} + c // 2 AS j, max(v)::DOUBLE AS v FROM conv GROUP BY 1, 2, 3)"""

#: From zero weights the head's first step is a plain mean, as above.
HEAD_SQL = f"""WITH {FEATURES_SQL}
SELECT CAST(c.range AS INTEGER) AS class, CAST(j AS INTEGER) AS pos,
       round(-0.1::DOUBLE * avg((0.1::DOUBLE - CAST(label = c.range AS INTEGER)) * v), 2) + 0.0::DOUBLE AS weight
FROM feature, range(10) c GROUP BY 1, 2"""


@query
def q_fit_head_first_step(spark, sf):
    """First step of a head on frozen convolution features, one worker, all rows in one batch."""
    zeros = {"fc.weight": np.zeros((10, 2 * (SIDE // 2 - 1) ** 2), np.float32), "fc.bias": np.zeros(10, np.float32)}
    _, done = fit.fit_head(
        images(spark, sf), FROZEN, _frozen(), 4, denom=1.0, head_params=zeros, batch=1 << 30, opt=arch.sgd(lr=0.1, momentum=0.0))
    return _weights(spark, done, 2)


NORMED = arch.Arch((("conv", "conv", 2, 0), ("batch_norm", "bn"), ("flatten",), ("dense", "fc", 10)), SIDE, SIDE)
PLACES = (SIDE - 2) ** 2

#: One step of the last layer and of the scale and shift of batch-norm, over frozen filters; the first weights are fc[c][j] = ((5 c + 3 j) % 7 - 3) / 64.
NORMED_SQL = f"""WITH {IMAGES_SQL},
conv AS (SELECT idx, label, f.range AS f, r.range * {SIDE - 2} + c.range AS place, ({_conv_terms()} - 100)::DOUBLE AS v
         FROM img, range(2) f, range({SIDE - 2}) r, range({SIDE - 2}) c),
channel AS (SELECT f, avg(v) AS m, var_pop(v) AS s FROM conv GROUP BY f),
centred AS (SELECT idx, label, f, f * {PLACES} + place AS j, (v - m) / sqrt(s + 1e-5::DOUBLE) AS v FROM conv JOIN channel USING (f)),
first AS (SELECT c.range AS c, j.range AS j, ((5 * c.range + 3 * j.range) % 7 - 3) / 64.0::DOUBLE AS w FROM range(10) c, range({2 * PLACES}) j),
score AS (SELECT idx, label, c, sum(v * w) AS s FROM centred JOIN first USING (j) GROUP BY 1, 2, 3),
top AS (SELECT idx, max(s) + ln(sum(exp(s - t))) AS z FROM (SELECT *, max(s) OVER (PARTITION BY idx) AS t FROM score) GROUP BY idx),
off AS (SELECT idx, c, exp(s - z) - CAST(label = c AS INTEGER) AS d FROM score JOIN top USING (idx)),
n AS (SELECT count(*)::DOUBLE AS n FROM img),
fc AS (SELECT c, j, sum(d * v) AS g FROM off JOIN centred USING (idx) GROUP BY 1, 2),
back AS (SELECT idx, j, sum(d * w) AS g FROM off JOIN first USING (c) GROUP BY 1, 2),
bn AS (SELECT f, sum(g * v) AS slope, sum(g) AS shift FROM back JOIN centred USING (idx, j) GROUP BY f)
SELECT 'fc.weight' AS name, CAST(c * {2 * PLACES} + j AS INTEGER) AS pos, round(w - 0.5::DOUBLE * g / n, 3) + 0.0::DOUBLE AS value FROM fc JOIN first USING (c, j), n
UNION ALL SELECT 'bn.weight', CAST(f AS INTEGER), round(1 - 0.5::DOUBLE * slope / n, 3) + 0.0::DOUBLE FROM bn, n
UNION ALL SELECT 'bn.bias', CAST(f AS INTEGER), round(-0.5::DOUBLE * shift / n, 3) + 0.0::DOUBLE FROM bn, n
UNION ALL SELECT 'conv.weight', CAST(f.range * 9 + k.range AS INTEGER), ((f.range + 3 * (k.range // 3) + 5 * (k.range % 3)) % 5 - 2)::DOUBLE FROM range(2) f, range(9) k"""


@query
def q_fit_head_and_batch_norm(spark, sf):
    """One step that trains the last layer and batch-norm and leaves the filters as they are."""
    shapes = {name: shape for name, shape, _ in arch.param_shapes(NORMED)}
    params = {name: a for name, a in arch.init_params(NORMED).items() if name.startswith("bn.")} | {
        name: a for name, a in _frozen().items() if name.startswith("conv.")} | {
        "fc.weight": np.fromfunction(lambda c, j: (5 * c + 3 * j) % 7 - 3, shapes["fc.weight"]).astype(np.float32) / 64, "fc.bias": np.zeros(10, np.float32)}
    done = fit.fit(
        images(spark, sf), NORMED, batch=1_000_000, denom=1.0, params=params, train_only=("fc", "bn"), opt=arch.sgd(lr=0.5, momentum=0.0))
    rows = [(name, pos, float(v)) for name in ("fc.weight", "bn.weight", "bn.bias", "conv.weight") for pos, v in enumerate(done.params[name].ravel())]
    return spark.createDataFrame(rows, "name string, pos int, value double").withColumn("value", F.round("value", 3) + 0.0)


def _adam_step(t, m, q):
    return f"0.05::DOUBLE * ({m} / {1 - 0.9 ** t!r}::DOUBLE) / (sqrt({q} / {1 - 0.999 ** t!r}::DOUBLE) + 1e-8::DOUBLE)"


#: Two full-batch steps of Adam; the second one weighs the first gradient with both decay rates.
ADAM_TWICE_SQL = f"""WITH {FIRST_GRADIENT_SQL},
w1 AS (SELECT c, j, g, -{_adam_step(1, '(0.1::DOUBLE * g)', '(0.001::DOUBLE * g * g)')} AS w FROM g1),
bias AS (SELECT c, -{_adam_step(1, '(0.1::DOUBLE * g)', '(0.001::DOUBLE * g * g)')} AS w FROM b1),
score AS (SELECT idx, label, w1.c, sum(w1.w * v) + any_value(bias.w) AS s FROM cells JOIN w1 USING (j) JOIN bias ON bias.c = w1.c GROUP BY 1, 2, 3),
top AS (SELECT idx, ln(sum(exp(s))) AS z FROM score GROUP BY idx),
off AS (SELECT idx, c, exp(s - z) - CAST(label = c AS INTEGER) AS d FROM score JOIN top USING (idx)),
g2 AS (SELECT c, j, avg(d * v) AS g FROM off JOIN cells USING (idx) GROUP BY 1, 2)
SELECT class, round(sum(weight), 2) + 0.0::DOUBLE AS total, round(sum(abs(weight)), 2) AS size FROM (
SELECT CAST(c AS INTEGER) AS class,
       w - {_adam_step(2, '(0.09::DOUBLE * w1.g + 0.1::DOUBLE * g2.g)', '(0.000999::DOUBLE * w1.g * w1.g + 0.001::DOUBLE * g2.g * g2.g)')} AS weight
FROM w1 JOIN g2 USING (c, j)) GROUP BY class"""


@query
def q_fit_adam_two_steps(spark, sf):
    """Sums of the weights of each class: single ones depend on the last bits of small gradients, which Adam scales up."""
    done = _from_zero(spark, sf, epochs=2, opt=arch.adam(lr=0.05)).params["fc.weight"].astype(float)
    rows = [(c, float(w.sum()), float(np.abs(w).sum())) for c, w in enumerate(done)]
    table = spark.createDataFrame(rows, "class int, total double, size double")
    return table.select("class", (F.round("total", 2) + 0.0).alias("total"), F.round("size", 2).alias("size"))


def _minibatch_sql(batch=64, rate=0.5, seed=42):
    """Every minibatch of one epoch in turn: rows by md5 of their key, their places permuted by rounds of md5 on two digits, cut into batches."""
    walk = "struct_pack(a := p // side, b := p % side)"
    for i in range(6):
        walk = f"list_transform([{walk}], lambda d: struct_pack(a := d.b, b := (d.a + ('0x' || left(md5('{seed}:0:{i}:' || d.b), 8))::BIGINT) % side))[1]"
    return f"""WITH RECURSIVE {IMAGES_SQL},
based AS (SELECT label, list_transform(px, lambda v: v / 255.0::DOUBLE) AS x, count(*) OVER () AS n,
                 row_number() OVER (ORDER BY md5('{seed}:0:' || split || ':' || idx)) - 1 AS pos FROM img),
sided AS (SELECT *, ceil(sqrt(n))::BIGINT AS side FROM based),
walked AS (
  SELECT pos, n, side, pos AS p, 0 AS steps FROM sided
  UNION ALL
  SELECT pos, n, side, d.a * side + d.b, steps + 1 FROM (SELECT pos, n, side, steps, {walk} AS d FROM walked WHERE steps = 0 OR p >= n)),
placed AS (SELECT w.p AS place, label, x FROM walked w JOIN sided USING (pos) WHERE w.steps > 0 AND w.p < w.n),
cut AS (SELECT place // {batch} AS step, label, x FROM placed),
fit AS (
  SELECT 0 AS step, list_transform(range(10), lambda c: list_transform(range({N}), lambda j: 0::DOUBLE)) AS w, list_transform(range(10), lambda c: 0::DOUBLE) AS b
  UNION ALL
  SELECT step + 1, list(wc ORDER BY c), list(bc ORDER BY c) FROM (
    SELECT step, c, list(g ORDER BY j) AS wc, any_value(bg) AS bc FROM (
      SELECT step, c, j, any_value(w[c + 1][j + 1]) - {rate}::DOUBLE * avg(d * x[j + 1]) AS g, any_value(b[c + 1]) - {rate}::DOUBLE * avg(d) AS bg
      FROM (SELECT step, w, b, x, c.range AS c, exp(s[c.range + 1] - list_max(s)) / list_sum(list_transform(s, lambda v: exp(v - list_max(s)))) - CAST(label = c.range AS INTEGER) AS d
            FROM (SELECT f.step, f.w, f.b, x, label, list_transform(range(10), lambda c: list_dot_product(x, f.w[c + 1]) + f.b[c + 1]) AS s FROM fit f JOIN cut ON cut.step = f.step), range(10) c),
           (SELECT range AS j FROM range({N}))
      GROUP BY step, c, j) GROUP BY step, c) GROUP BY step),
done AS (SELECT w FROM fit ORDER BY step DESC LIMIT 1)
SELECT CAST(c.range AS INTEGER) AS class, CAST(j.range AS INTEGER) AS pos, round(w[c.range + 1][j.range + 1], 3) + 0.0::DOUBLE AS weight
FROM done, range(10) c, range({N}) j"""


@query
def q_fit_minibatches(spark, sf):
    """One worker, one epoch of ordinary minibatches of 64 rows, the last one shorter, from zero parameters."""
    net = arch.arch("softmax", SIDE, SIDE)
    zeros = {name: np.zeros(shape, np.float32) for name, shape, _ in arch.param_shapes(net)}
    return _weights(spark, fit.fit(images(spark, sf), net, batch=64, params=zeros, opt=arch.sgd(lr=0.5, momentum=0.0)), 3)


ORACLE |= {
    "q_fit_head_first_step": HEAD_SQL, "q_fit_head_and_batch_norm": NORMED_SQL, "q_fit_adam_two_steps": ADAM_TWICE_SQL,
    "q_fit_minibatches": _minibatch_sql(),
}
