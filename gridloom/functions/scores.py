"""Element-wise activations, batch-norm, dropout and cross-entropy as built-in array expressions."""

from pyspark.sql import functions as F


def relu(x):
    return F.transform(x, lambda v: F.greatest(v, F.lit(0).cast("double")))


def silu(x):
    return F.transform(x, lambda v: v / (F.lit(1.0) + F.exp(-v)))


def round_to(v, digits):
    """SQL's round of a double: round(v * 10^digits) half away from zero, divided back.

    Spark's round goes through a decimal and turns a negative value that rounds to zero into 0.0; this keeps -0.0,
    and gives v back where the scaled value is not finite.
    """
    scale = F.lit(10.0 ** digits)
    r = F.round(v * scale, 0) / scale
    return (F.when(F.isnan(r) | (F.abs(r) == F.lit(float("inf"))), v)
            .when(r == F.lit(0.0), v * F.lit(0.0))
            .otherwise(r))


def batch_norm(x, stats, area, eps=1e-5):
    """Normalise with fixed per-channel figures; stats is a list of (mean, var, gamma, beta) per channel."""
    mean, var, gamma, beta = (F.array(*[F.lit(float(s[i])) for s in stats]) for i in range(4))

    def one(v, i):
        c = F.floor(i / F.lit(area)).cast("int")
        return (v - F.get(mean, c)) / F.sqrt(F.get(var, c) + F.lit(eps)) * F.get(gamma, c) + F.get(beta, c)

    return F.transform(x, one)


def dropout(x, keys, p=0.5, seed=42, epoch=0):
    """Zero each unit with probability p and scale the rest by 1/(1-p).

    The choice is a hash of (seed, epoch, row key, unit), so a repeated run drops the same units.
    """
    prefix = F.concat_ws(":", F.lit(seed), F.lit(epoch), *[F.col(k).cast("string") for k in keys])

    def one(v, i):
        digest = F.md5(F.concat_ws(":", prefix, i.cast("string")))
        u = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
        return F.when(u < F.lit(p), F.lit(0.0)).otherwise(v / F.lit(1.0 - p))

    return F.transform(x, one)


def cross_entropy(scores, label):
    """-log softmax(scores)[label].

    One pass over the scores keeps the largest one so far and the sum of exp(score - largest), which is scaled down whenever a larger one
    comes, so exp cannot overflow and no expression over all scores stands inside the pass.
    """
    def step(acc, s):
        grown = F.struct(s.alias("top"), (acc["total"] * F.exp(acc["top"] - s) + F.lit(1.0)).alias("total"))
        return F.when(s > acc["top"], grown).otherwise(F.struct(acc["top"].alias("top"), (acc["total"] + F.exp(s - acc["top"])).alias("total")))

    start = F.struct(F.lit(float("-inf")).alias("top"), F.lit(0.0).alias("total"))
    log_sum = F.aggregate(scores, start, step, lambda acc: F.log(acc["total"]) + acc["top"])
    return log_sum - F.get(scores, label)
