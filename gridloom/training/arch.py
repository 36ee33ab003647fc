"""Network layouts as plain layer lists, their parameter shapes and first values, and optimizer settings."""

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Arch:
    layers: tuple
    height: int
    width: int
    channels: int = 1


def arch(name, height=28, width=28, classes=10):
    """A: one unpadded convolution. B: two padded. C: B with batch-norm and dropout.
    D: three with batch-norm and SiLU. softmax: one dense layer."""
    # Layer sizes are fixed values.
    flat, relu, silu, pool = ("flatten",), ("relu",), ("silu",), ("pool",)
    layouts = {
        "A": [("conv", "conv1", 32, 0), relu, pool, flat,
              ("dense", "fc1", 128), relu, ("dense", "fc2", classes)],
        "B": [("conv", "conv1", 32, 1), relu, pool, ("conv", "conv2", 64, 1), relu, pool, flat,
              ("dense", "fc1", 128), relu, ("dense", "fc2", classes)],
        "C": [("conv", "conv1", 32, 1), ("batch_norm", "bn1"), relu, pool,
              ("conv", "conv2", 64, 1), ("batch_norm", "bn2"), relu, pool, flat,
              ("dense", "fc1", 128), relu, ("dropout", 0.5), ("dense", "fc2", classes)],
        "D": [("conv", "conv1", 32, 1), ("batch_norm", "bn1"), silu, pool,
              ("conv", "conv2", 64, 1), ("batch_norm", "bn2"), silu, pool,
              ("conv", "conv3", 128, 1), ("batch_norm", "bn3"), silu, pool, flat,
              ("dense", "fc1", 256), silu, ("dropout", 0.5), ("dense", "fc2", 128), silu,
              ("dense", "fc3", classes)],
        "softmax": [flat, ("dense", "fc", classes)],
    }
    return Arch(tuple(layouts[name]), height, width)


def n_classes(net):
    """Width of the last dense layer."""
    return [layer[2] for layer in net.layers if layer[0] == "dense"][-1]


def param_shapes(net):
    """(name, shape, inputs per output unit) of every trained parameter, in layer order."""
    shape, found = (net.channels, net.height, net.width), []
    for kind, *args in net.layers:
        if kind == "conv":
            name, out, pad = args
            found += [(f"{name}.weight", (out, shape[0], 3, 3), shape[0] * 9), (f"{name}.bias", (out,), shape[0] * 9)]
            shape = (out, shape[1] + 2 * pad - 2, shape[2] + 2 * pad - 2)
        elif kind == "batch_norm":
            found += [(f"{args[0]}.weight", (shape[0],), 0), (f"{args[0]}.bias", (shape[0],), 0)]
        elif kind == "pool":
            shape = (shape[0], shape[1] // 2, shape[2] // 2)
        elif kind == "flatten":
            shape = (int(np.prod(shape)),)
        elif kind == "dense":
            found += [(f"{args[0]}.weight", (args[1], shape[0]), shape[0]), (f"{args[0]}.bias", (args[1],), shape[0])]
            shape = (args[1],)
    return found


def init_params(net, seed=42):
    """Uniform in +-1/sqrt(inputs); batch-norm starts as the identity with running mean 0 and variance 1."""
    rng = np.random.default_rng(seed)
    params = {}
    for name, shape, inputs in param_shapes(net):
        if inputs:
            bound = inputs ** -0.5
            params[name] = rng.uniform(-bound, bound, shape).astype(np.float32)
        elif name.endswith(".weight"):
            params[name] = np.ones(shape, np.float32)
        else:
            params[name] = np.zeros(shape, np.float32)
            layer = name.removesuffix(".bias")
            params[f"{layer}.running_mean"] = np.zeros(shape, np.float32)
            params[f"{layer}.running_var"] = np.ones(shape, np.float32)
    return params


def sgd(lr=0.01, momentum=0.9, weight_decay=0.0):
    return {"kind": "sgd", "lr": lr, "momentum": momentum, "weight_decay": weight_decay}


def adam(lr=0.001, betas=(0.9, 0.999), eps=1e-8, weight_decay=0.0):
    return {"kind": "adam", "lr": lr, "betas": betas, "eps": eps, "weight_decay": weight_decay}
