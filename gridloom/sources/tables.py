"""Labelled CSV, labelled text lines, whole data sets, listings and previews."""

import csv
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom import schemas
from gridloom.functions import pixels
from gridloom.operators.pairing import with_file_position


def first_line(spark, path):
    """First line of the first file by name that has one, else None; reads no other file."""
    for name in sorted(spark.read.text(path).inputFiles()):
        line = spark.read.text(name).first()
        if line is not None:
            return line.value
    return None


def read_labeled_csv(spark, path, side=28, label="label"):
    """CSV with a header row: the column named `label` and side * side pixel columns, in header order.

    The names come from the first file's header, so the label may stand anywhere; a file with another header, a wrong
    number of columns, a bad or an empty cell fails the job. There is no inference pass over the data.
    """
    line = first_line(spark, path)
    if line is None:
        return pack_wide(spark.createDataFrame([], schemas.wide_csv(side * side, label)), label)
    names = next(csv.reader([line]))
    if names.count(label) != 1 or len(names) != side * side + 1 or len(set(names)) != len(names):
        raise ValueError(f"expected one column {label!r} and {side * side} others, found {len(names)}: {names[:5]}")
    wide = spark.read.schema(T.StructType([T.StructField(n, T.IntegerType()) for n in names]))
    wide = wide.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    return pack_wide(wide, label)


def pack_wide(wide, label="label"):
    """One label column plus pixel columns to (label, px); a null cell fails the job."""
    cells = [f"`{c}`" for c in wide.columns if c != label]
    packed = wide.select(F.col(f"`{label}`").alias("label"), pixels.pack(cells).alias("px"))
    # each column checks itself, so that reading the label alone reads nothing else
    empty = F.exists("px", lambda v: v.isNull())
    return packed.select(
        F.coalesce("label", F.raise_error(F.lit("empty label cell")).cast("int")).alias("label"),
        F.when(empty, F.raise_error(F.lit("empty pixel cell")).cast("array<int>")).otherwise(F.col("px")).alias("px"),
    )


def drop_header_equal(lines, header):
    """Drop every line equal to the header line."""
    return lines.filter(F.col("value") != F.lit(header))


def drop_header_containing(lines, word="label"):
    """Drop every line that contains the word. A data line holding it goes too."""
    return lines.filter(~F.contains(F.col("value"), F.lit(word)))


def labels(df, label="label"):
    """The label column alone; on a columnar source nothing else is read."""
    return df.select(label)


def features(df, label="label"):
    """Everything but the label."""
    return df.drop(label)


def drop_skipped(df, columns=("label", "px")):
    """Drop records a parser marked as skipped (null)."""
    return df.na.drop(subset=list(columns))


def parse_labeled_lines(lines, n_pixels=None, values="int", mode="fail"):
    """Comma-separated lines to (label, px): field 0 is the label, the rest are pixels.

    values="int" gives whole-number pixels and refuses decimals; values="float" gives float pixels.
    mode="fail" stops at a bad cell or a wrong width. mode="quarantine" keeps such lines with a null label and
    px and fills `error`; good lines have a null `error`.
    """
    if values not in ("int", "float"):
        raise ValueError(f"unknown value type {values!r}")
    other = [c for c in lines.columns if c != "value"]
    fields = lines.select(*other, "value", F.split("value", ",").alias("_f"))
    cells = F.slice("_f", F.lit(2), F.greatest(F.size("_f") - 1, F.lit(0)))
    right_width = F.lit(True) if n_pixels is None else F.size("_f") == n_pixels + 1
    if mode == "fail":
        def checked(value, kind):
            if n_pixels is None:
                return value.cast(kind)
            text = F.format_string("expected %d fields: %.80s", F.lit(n_pixels + 1), F.col("value"))
            return F.when(right_width, value.cast(kind)).otherwise(F.raise_error(text).cast(kind))

        # The width check sits inside both columns: as a filter it would be pushed below the split and repeat it.
        return fields.select(
            *other, checked(F.get("_f", F.lit(0)), "int").alias("label"),
            checked(cells, f"array<{values}>").alias("px"),
        )
    if mode != "quarantine":
        raise ValueError(f"unknown mode {mode!r}")
    tried = fields.select(
        *other, "value", right_width.alias("_width"),
        F.get("_f", F.lit(0)).try_cast("int").alias("_label"),
        cells.try_cast(f"array<{values}>").alias("_px"),
    ).withColumn(
        "error",
        F.when(~F.col("_width"), "width")
        .when(F.col("_label").isNull(), "label")
        .when(F.exists("_px", lambda v: v.isNull()), "pixel"),
    )
    good = F.col("error").isNull()
    return tried.select(
        *other, F.when(good, F.col("_label")).alias("label"), F.when(good, F.col("_px")).alias("px"),
        "error", F.when(~good, F.col("value")).alias("bad_line"),
    )


def read_labeled_text(spark, path, header="first_line", n_pixels=None, values="int", mode="fail"):
    """Labelled text lines; header is "first_line", "contains_label" or "none".

    "first_line" drops every line equal to the first line of the first file by name.
    """
    lines = spark.read.text(path)
    if header == "first_line":
        first = first_line(spark, path)
        lines = lines if first is None else drop_header_equal(lines, first)
    elif header == "contains_label":
        lines = drop_header_containing(lines)
    elif header != "none":
        raise ValueError(f"unknown header rule {header!r}")
    return parse_labeled_lines(lines, n_pixels, values, mode)


def read_splits(read, **paths):
    """(split, idx, label, px) of several labelled files or folders, such as train=... and test=...

    read: path -> rows, for example lambda p: read_labeled_csv(spark, p). idx numbers each split's rows from 0 in the order of
    its files' names and lines.
    """
    parts = [with_file_position(read(path).withColumn("split", F.lit(name))) for name, path in paths.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).select("split", "idx", "label", "px")


def file_inventory(spark, path):
    """Name, size and time of every file. The content column is never read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "path", "length", "modificationTime"
    )


def preview(df, keys, n=5):
    """First n rows in key order, planned as a top-k."""
    return df.orderBy(*keys).limit(n)
