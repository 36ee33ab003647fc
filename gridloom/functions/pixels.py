"""Pixel arrays: quantise, scale, reshape, encode, render."""

from pyspark.sql import functions as F


def to_pixels(vector):
    """Real values in [-1, 1] to bytes 0..255, clamped."""
    def one(v):
        level = F.floor((v.cast("double") + F.lit(1.0)) * F.lit(127.5))
        return F.greatest(F.lit(0), F.least(F.lit(255), level.cast("int")))
    return F.transform(vector, one)


def scale_pixels(px, denom=255.0):
    """Bytes to float32 in [0, 1]. Dividing in double and rounding once gives the float32 quotient."""
    return F.transform(px, lambda v: (v.cast("double") / F.lit(float(denom))).cast("float"))


def reshape_rows(px, height, width):
    """Flat row-major vector to height arrays of width values."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(height - 1)),
        lambda r: F.slice(px, r * F.lit(width) + F.lit(1), F.lit(width)),
    )


def reshape(px, height, width, channels=1):
    """Flat vector to channels x height x width (channel axis first)."""
    size = height * width
    return F.transform(
        F.sequence(F.lit(0), F.lit(channels - 1)),
        lambda c: reshape_rows(F.slice(px, c * F.lit(size) + F.lit(1), F.lit(size)), height, width),
    )


def flatten(nested, depth=1):
    """Undo reshape_rows (depth 1) or reshape (depth 2)."""
    for _ in range(depth):
        nested = F.flatten(nested)
    return nested


def one_hot(label, k=10):
    return F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda i: F.when(i == label, F.lit(1.0)).otherwise(F.lit(0.0)).cast("float"),
    )


def argmax(scores):
    """Position of the largest value, counted from 0; the lowest position wins a tie."""
    return (F.array_position(scores, F.array_max(scores)) - F.lit(1)).cast("int")


def render_grid(px, width):
    """Text picture: values right-aligned to 3 characters plus a space, one line per image row."""
    def cell(v):
        s = v.cast("string")
        padded = F.when(F.length(s) >= 3, s).otherwise(F.lpad(s, 3, " "))
        return F.concat(padded, F.lit(" "))
    last_row = F.call_function("div", F.size(px), F.lit(width)).cast("int") - F.lit(1)
    lines = F.transform(
        F.sequence(F.lit(0), last_row),
        lambda r: F.array_join(F.transform(F.slice(px, r * F.lit(width) + F.lit(1), F.lit(width)), cell), ""),
    )
    return F.array_join(lines, "\n")


def pack(columns):
    """Wide pixel columns to one array column."""
    return F.array(*[F.col(c) for c in columns])


def version_name(ts, prefix="model_checkpoint"):
    return F.concat(F.lit(prefix), F.lit("_"), F.date_format(ts, "yyyyMMdd_HHmmss"), F.lit(".pth"))
