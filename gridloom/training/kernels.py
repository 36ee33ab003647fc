"""Forward and backward steps of the layers on one in-memory minibatch (NumPy, used inside tasks).

Images are held as (row, height, width, channel) so that a convolution is one matrix product whose operands and
result need no transposition.
"""

import numpy as np


def _windows(x, k, pad):
    """The k x k surroundings of every place, one row each, channels innermost."""
    if pad:
        x = np.pad(x, ((0, 0), (pad, pad), (pad, pad), (0, 0)))
    windows = np.lib.stride_tricks.sliding_window_view(x, (k, k), axis=(1, 2))
    n, oh, ow, c = windows.shape[:4]
    return windows.transpose(0, 1, 2, 4, 5, 3).reshape(n * oh * ow, k * k * c), (n, oh, ow)


def _weight_matrix(w):
    """(out, in, k, k) as (k * k * in, out)."""
    return np.ascontiguousarray(w.transpose(2, 3, 1, 0)).reshape(-1, len(w))


def conv(x, w, b, pad):
    """Stride-1 convolution, and the windows for the backward step."""
    cols, places = _windows(x, w.shape[2], pad)
    y = cols @ _weight_matrix(w)
    y += b
    return y.reshape(*places, len(w)), cols


def conv_back(g, x_shape, w, cols, pad, need_dx=True):
    n, h, wd, c = x_shape
    o, _, k, _ = w.shape
    oh, ow = g.shape[1:3]
    rows = g.reshape(-1, o)
    dw = (cols.T @ rows).reshape(k, k, c, o).transpose(3, 2, 0, 1)
    if not need_dx:
        return None, dw, rows.sum(axis=0)
    dcols = (rows @ _weight_matrix(w).T).reshape(n, oh, ow, k, k, c)
    dx = np.zeros((n, h + 2 * pad, wd + 2 * pad, c), g.dtype)
    for i in range(k):
        for j in range(k):
            dx[:, i:i + oh, j:j + ow] += dcols[:, :, :, i, j]
    return dx[:, pad:pad + h, pad:pad + wd], dw, rows.sum(axis=0)


def _corners(x):
    """The four cells of every 2x2 field; an odd last row or column takes no part."""
    h, w = x.shape[1] // 2 * 2, x.shape[2] // 2 * 2
    return [x[:, i:h:2, j:w:2] for i in (0, 1) for j in (0, 1)]


def pool(x):
    """Largest value of every 2x2 field, stride 2."""
    a, b, c, d = _corners(x)
    return np.maximum(np.maximum(a, b), np.maximum(c, d))


def pool_back(g, x, y):
    """The gradient goes to the first cell that holds the maximum."""
    dx = np.zeros(x.shape, g.dtype)
    taken = np.zeros(y.shape, bool)
    for source, target in zip(_corners(x), _corners(dx)):
        hit = source == y
        np.multiply(g, hit & ~taken, out=target)
        taken |= hit
    return dx


def forward(layers, params, x, rng=None, eps=1e-5):
    """Scores of channel-first images, plus what `backward` needs. With rng: training mode (batch statistics, dropout)."""
    tape, batch_stats = [], {}
    x = x.transpose(0, 2, 3, 1)
    for kind, *args in layers:
        saved = None
        if kind == "conv":
            name, _, pad = args
            y, cols = conv(x, params[f"{name}.weight"], params[f"{name}.bias"], pad)
            saved = (x.shape, cols)
        elif kind == "batch_norm":
            name = args[0]
            weight, bias = params[f"{name}.weight"], params[f"{name}.bias"]
            if rng is None:
                slope = weight / np.sqrt(params[f"{name}.running_var"] + eps).astype(x.dtype)
                y = x * slope
                y += bias - params[f"{name}.running_mean"] * slope
            else:
                mean, var = x.mean(axis=(0, 1, 2)), x.var(axis=(0, 1, 2))
                batch_stats[name] = (mean, var, x.size // x.shape[3])
                scale = (1 / np.sqrt(var + eps)).astype(x.dtype)
                centred = (x - mean) * scale
                y = centred * weight + bias
                saved = (centred, scale)
        elif kind == "relu":
            y, saved = np.maximum(x, 0), x > 0
        elif kind == "silu":
            grown = np.exp(-x)
            grown += 1
            y = x / grown
            saved = None if rng is None else (1 + x - y) / grown
        elif kind == "pool":
            y = pool(x)
            saved = (x, y)
        elif kind == "flatten":
            # Flat vectors are channel first.
            y, saved = x.transpose(0, 3, 1, 2).reshape(len(x), -1), x.shape
        elif kind == "dropout":
            keep = 1 if rng is None else (rng.random(x.shape) >= args[0]).astype(x.dtype) / x.dtype.type(1 - args[0])
            y, saved = x * keep, keep
        elif kind == "dense":
            y, saved = x @ params[f"{args[0]}.weight"].T + params[f"{args[0]}.bias"], x
        else:
            raise ValueError(f"unknown layer {kind!r}")
        if rng is not None:
            tape.append(saved)
        x = y
    return x, tape, batch_stats


def backward(layers, params, tape, g):
    """Gradients by parameter name, given the gradient of the loss with respect to the scores."""
    grads = {}
    for i, saved in reversed(list(enumerate(tape))):
        kind, *args = layers[i]
        if kind == "conv":
            shape, cols = saved
            w = params[f"{args[0]}.weight"]
            g, grads[f"{args[0]}.weight"], grads[f"{args[0]}.bias"] = conv_back(
                g, shape, w, cols, args[2], need_dx=i > 0
            )
        elif kind == "batch_norm":
            centred, scale = saved
            n = g.size // g.shape[3]
            slope, shift = (g * centred).sum(axis=(0, 1, 2)), g.sum(axis=(0, 1, 2))
            grads[f"{args[0]}.weight"], grads[f"{args[0]}.bias"] = slope, shift
            # The batch mean and variance depend on the input too; both enter through the sums above.
            pull = centred * (slope / n)
            pull += shift / n
            g = (g - pull) * (params[f"{args[0]}.weight"] * scale)
        elif kind in ("relu", "silu", "dropout"):
            g = g * saved
        elif kind == "pool":
            g = pool_back(g, *saved)
        elif kind == "flatten":
            n, height, width, channels = saved
            g = g.reshape(n, channels, height, width).transpose(0, 2, 3, 1)
        elif kind == "dense":
            grads[f"{args[0]}.weight"], grads[f"{args[0]}.bias"] = g.T @ saved, g.sum(axis=0)
            g = g @ params[f"{args[0]}.weight"]
    return grads


def cross_entropy(scores, y):
    """Mean loss over the batch and its gradient."""
    shifted = scores - scores.max(axis=1, keepdims=True)
    log_p = shifted - np.log(np.exp(shifted).sum(axis=1, keepdims=True))
    rows = np.arange(len(y))
    g = np.exp(log_p)
    g[rows, y] -= 1
    return float(-log_p[rows, y].mean()), g / len(y)


def update(opt, params, grads, state):
    """One in-place optimizer step; `state` holds the arrays an optimizer carries along."""
    lr, decay = opt["lr"], opt["weight_decay"]
    state["step"] = state.get("step", np.zeros(1, np.float32)) + np.float32(1)
    t = float(state["step"][0])
    for name, g in grads.items():
        if decay:
            g = g + decay * params[name]
        if opt["kind"] == "sgd":
            v = opt["momentum"] * state.get(f"momentum/{name}", np.zeros_like(g)) + g
            state[f"momentum/{name}"] = v
            params[name] = (params[name] - lr * v).astype(params[name].dtype)
        else:
            b1, b2 = opt["betas"]
            m = b1 * state.get(f"mean/{name}", np.zeros_like(g)) + (1 - b1) * g
            q = b2 * state.get(f"square/{name}", np.zeros_like(g)) + (1 - b2) * g * g
            state[f"mean/{name}"], state[f"square/{name}"] = m, q
            step = lr * (m / (1 - b1 ** t)) / (np.sqrt(q / (1 - b2 ** t)) + opt["eps"])
            params[name] = (params[name] - step).astype(params[name].dtype)
