import numpy as np
import pytest
from pyspark.errors import PySparkException

from gridloom.operators import layers
from gridloom.training import arch, kernels


def frame(spark, arrays, kind="int"):
    rows = [(i, [v.item() for v in a]) for i, a in enumerate(arrays)]
    return spark.createDataFrame(rows, f"id int, px array<{kind}>").repartition(3)


def naive_conv(image, w, b, pad):
    c, h, wd = image.shape
    padded = np.zeros((c, h + 2 * pad, wd + 2 * pad), image.dtype)
    padded[:, pad:pad + h, pad:pad + wd] = image
    k = w.shape[2]
    out = np.zeros((len(w), padded.shape[1] - k + 1, padded.shape[2] - k + 1), image.dtype)
    for o in range(out.shape[0]):
        for r in range(out.shape[1]):
            for s in range(out.shape[2]):
                out[o, r, s] = (padded[:, r:r + k, s:s + k] * w[o]).sum() + b[o]
    return out


@pytest.mark.parametrize("pad", [0, 1])
def test_conv_matches_the_definition(spark, pad):
    rng = np.random.default_rng(0)
    images = rng.integers(0, 256, (5, 2, 4, 6))
    w, b = rng.integers(-3, 4, (3, 2, 3, 3)), rng.integers(-3, 4, 3)
    got = layers.conv2d(frame(spark, images.reshape(5, -1)), w, b, 4, 6, pad).collect()
    for r in got:
        assert r.conv == naive_conv(images[r.id], w, b, pad).ravel().tolist()


def test_pool_operator(spark):
    # 3 x 5 image: only the first 2 rows and 4 columns take part.
    x = np.array([[1, 2, 3, 4, 99, 5, 6, 7, 8, 99, 99, 99, 99, 99, 99]])
    assert layers.max_pool2d(frame(spark, x), 3, 5).first().pooled == [6, 8]
    two = np.array([[1, 2, 3, 4, 8, 7, 6, 5]])
    assert layers.max_pool2d(frame(spark, two), 2, 2, channels=2).first().pooled == [4, 8]
    assert layers.max_pool2d(frame(spark, two * 0.5, "double"), 2, 2, channels=2).first().pooled == [2.0, 4.0]


def test_dense_is_exact_on_whole_numbers(spark):
    x = np.array([[1, 2, 3], [4, 5, 6]])
    got = {r.id: r.dense for r in layers.dense(frame(spark, x), [[1, 0, -1], [2, 2, 2]], [10, 0]).collect()}
    assert got == {0: [8, 12], 1: [8, 30]}


def test_ragged_rows_fail(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([1, 2],)], "px array<int>").coalesce(1)
    with pytest.raises(PySparkException, match="expected 3"):
        layers.dense(df, [[1, 1, 1]], [0]).collect()


def test_a_null_value_fails(spark):
    df = spark.createDataFrame([([1, 2],), ([1, None],)], "px array<int>").coalesce(1)
    with pytest.raises(PySparkException, match="null value"):
        layers.dense(df, [[1, 1]], [0]).collect()


def test_batch_norm_far_from_zero(spark):
    x = 1e8 + np.random.default_rng(1).normal(0, 1, (60, 1, 4))
    parts = frame(spark, x.reshape(60, -1), "double").repartition(6)
    got = layers.batch_norm_fit(parts, 1, 4, "px").first()
    assert got["mean"] == pytest.approx(x.mean(), rel=1e-12) and got.variance == pytest.approx(x.var(), rel=1e-4)


def test_batch_norm_figures(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(2, 3, (50, 3, 4))
    got = {r.channel: r for r in layers.batch_norm_fit(frame(spark, x.reshape(50, -1), "double"), 3, 4, "px").collect()}
    for c in range(3):
        assert got[c]["mean"] == pytest.approx(x[:, c].mean()) and got[c].variance == pytest.approx(x[:, c].var())


def test_class_sums_with_a_hot_label(spark):
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 256, (300, 5)), np.where(np.arange(300) % 3, rng.integers(0, 4, 300), 2)
    df = frame(spark, x).join(spark.createDataFrame([(i, int(c)) for i, c in enumerate(y)], "id int, label int"), "id")
    got = {(r.label, r.pos): (r.total, r.n) for r in layers.class_sums(df).collect()}
    assert got == {
        (c, j): (x[y == c, j].sum(), (y == c).sum()) for c in np.unique(y) for j in range(5)
    }


# --- kernels -------------------------------------------------------------------------------------------------

def test_pool_kernel_drops_the_odd_tail():
    y = kernels.pool(np.arange(49).reshape(1, 7, 7, 1))
    assert y.shape == (1, 3, 3, 1) and y[0, 2, 2, 0] == 5 * 7 + 5


def test_pool_gradient_goes_to_the_first_maximum():
    x = np.array([[5.0, 5.0], [1.0, 5.0]]).reshape(1, 2, 2, 1)
    dx = kernels.pool_back(np.array([[[[3.0]]]]), x, kernels.pool(x))
    assert dx.ravel().tolist() == [3.0, 0.0, 0.0, 0.0]


@pytest.mark.parametrize("name, count", [("A", 693962), ("B", 421642), ("C", 421834), ("D", 422474)])
def test_parameter_counts(name, count):
    assert sum(int(np.prod(shape)) for _, shape, _ in arch.param_shapes(arch.arch(name))) == count


def test_first_values_depend_on_the_seed_only():
    net = arch.arch("C", 8, 8)
    a, b, c = arch.init_params(net, 1), arch.init_params(net, 1), arch.init_params(net, 2)
    assert all((a[k] == b[k]).all() for k in a) and any((a[k] != c[k]).any() for k in a)


@pytest.mark.parametrize("name", ["softmax", "A", "B", "C", "D"])
def test_gradients_match_finite_differences(name):
    net = arch.arch(name, 8, 8)
    rng = np.random.default_rng(3)
    params = {k: v.astype(np.float64) for k, v in arch.init_params(net, 4).items()}
    x, y = rng.normal(size=(6, 1, 8, 8)), rng.integers(0, 10, 6)

    def loss_at(p):
        scores, tape, _ = kernels.forward(net.layers, p, x, np.random.default_rng(9))
        return kernels.cross_entropy(scores, y), tape

    (_, g), tape = loss_at(params)
    grads = kernels.backward(net.layers, params, tape, g)
    for key, grad in grads.items():
        for at in rng.integers(0, grad.size, 3):
            diffs = []
            for eps in (1e-6, -1e-6):
                moved = {k: v.copy() for k, v in params.items()}
                moved[key].flat[at] += eps
                diffs.append(loss_at(moved)[0][0])
            assert (diffs[0] - diffs[1]) / 2e-6 == pytest.approx(grad.flat[at], abs=2e-6)


def test_sgd_momentum_and_decay_by_hand():
    params, state = {"w": np.array([1.0])}, {}
    opt = arch.sgd(lr=0.1, momentum=0.9, weight_decay=0.01)
    kernels.update(opt, params, {"w": np.array([2.0])}, state)
    assert params["w"][0] == pytest.approx(1 - 0.1 * 2.01)
    before = params["w"][0]
    kernels.update(opt, params, {"w": np.array([1.0])}, state)
    assert params["w"][0] == pytest.approx(before - 0.1 * (0.9 * 2.01 + 1 + 0.01 * before))


def test_adam_first_step_is_the_learning_rate():
    params, state = {"w": np.array([1.0, 1.0])}, {}
    kernels.update(arch.adam(lr=0.001), params, {"w": np.array([5.0, -0.01])}, state)
    assert params["w"] == pytest.approx([1 - 0.001, 1 + 0.001], abs=1e-6)
