"""Document fingerprints by consistent weighted sampling, in SQL expressions only.

A text's terms are its pairs of neighbouring words with their number of occurrences as weight S. For each sample and term, two Gamma(2, 1)
variables r and c and a uniform b come from the term's hash; t = floor(ln S / r + b), and the term with the smallest
ln c - r (t - b + 1) is sampled, with its t. Two texts draw the same (term, t) with a chance that equals the generalised
Jaccard similarity of their weights, the sum of the smaller weights over the sum of the larger.

The texts are shuffled once, by ranges of ids; counting, sampling and comparing happen inside a range.
"""

from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.llm.common import quantiles, read

#: Samples in a fingerprint.
SAMPLES = 32
#: Bits of a sample that name the term and its t; the others order the samples.
NAME = 20


def terms(text):
    """Struct array (term, weight) of a text column's neighbouring words; a single word is its own term, no word gives none."""
    words = F.filter(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), lambda w: w != "")
    return words.alias("words")


def counted(df, text, out):
    """Adds column out: array of (term, weight) of the text column."""
    df = df.withColumn("_w", terms(F.col(text)))
    n = F.size("_w")
    pairs = F.transform("_w", lambda w, i: F.xxhash64(w, F.get("_w", i + 1)))
    df = df.withColumn("_t", F.when(n < 2, F.transform("_w", lambda w: F.xxhash64(w))).otherwise(F.sort_array(F.slice(pairs, 1, F.greatest(n - 1, F.lit(1))))))
    size = F.size("_t")
    begin = F.when(size > 0, F.filter(F.sequence(F.lit(0), size - 1), lambda i: (i == 0) | (F.get("_t", i) != F.get("_t", i - 1)))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_b", begin)
    made = F.transform("_b", lambda at, j: F.struct(F.get("_t", at).alias("term"), (F.coalesce(F.get("_b", j + 1), F.size("_t")) - at).alias("weight")))
    return df.withColumn(out, made).drop("_w", "_t", "_b")


def sample(i):
    """Least value of sample i over the terms of a group; its low bits name the term and its t."""
    h = F.xxhash64("term", F.lit(i))

    def uniform(shift, bits):
        return (F.shiftrightunsigned(h, shift).bitwiseAND((1 << bits) - 1) + 0.5) / float(1 << bits)

    r = -F.log(uniform(0, 12) * uniform(12, 12))
    ln_c = F.log(-F.log(uniform(24, 12) * uniform(36, 12)))
    b = uniform(48, 16)
    t = F.floor(F.col("ln_s") / r + b)
    value = ln_c - r * (t - b + 1)
    name = h.bitwiseXOR(t * 0x9E3779B1).bitwiseAND((1 << NAME) - 1)
    # 63 bits: the value in fixed point (it lies between -64 and 64 for weights below e^50), then the name
    ordered = ((value + 64.0) * float(1 << (63 - NAME - 7))).cast("long")
    return F.min(F.shiftleft(ordered, NAME).bitwiseOR(name))


def likeness(a, b):
    """Share of equal samples of two fingerprint columns; two empty ones are alike, an empty and another one are not."""
    same = F.aggregate(F.arrays_zip(a.alias("a"), b.alias("b")), F.lit(0), lambda n, x: n + F.when(x["a"] == x["b"], 1).otherwise(0))
    empty_a, empty_b = F.get(a, F.lit(0)).isNull(), F.get(b, F.lit(0)).isNull()
    return F.when(empty_a & empty_b, 1.0).when(empty_a | empty_b, 0.0).otherwise(same / float(SAMPLES))


def text_form(samples):
    """A fingerprint as text: 8 hexadecimal digits for each sample, none for texts without terms."""
    digits = F.transform(samples, lambda x: F.lpad(F.lower(F.hex(F.xxhash64(x).bitwiseAND(0xFFFFFFFF))), 8, "0"))
    return F.when(F.get(samples, F.lit(0)).isNull(), "").otherwise(F.concat_ws("", digits))


def fingerprints(docs, id_col="doc_id", text_col="text", parts=None):
    """Fingerprint of every text and of its edited text, and how alike they and the next document's are.

    The edited text: the last floor(n_chars / 2) code points are replaced by the first as many (or all) of the next document by ascending
    id, after the last the first. Returns id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next. Null texts count as empty; equal texts have equal fingerprints; rows with one id are ordered by a hash of
    the text; a null id comes first. With 32 samples a likeness has a standard error of up to 0.09. A table of one row is its own next. Other columns are left out.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a key with a range's worth of rows or more is cut further, by a hash of the text
    cuts, hot = [], []
    for value, times in sorted(Counter(quantiles(source, parts, "key")).items()):
        cuts += [(value, -(1 << 63) + k * ((1 << 64) // times)) for k in range(times)]
        hot += [value] if times > 1 else []
    h = F.when(F.col("key").isin(hot), F.xxhash64("text")).otherwise(F.lit(0)) if hot else F.lit(0)

    def places(pairs):
        made = [F.struct(F.lit(k).cast("long").alias("key"), F.lit(x).cast("long").alias("h")) for k, x in pairs]
        return F.array(*made).cast("array<struct<key:bigint,h:bigint>>")

    place = F.struct(F.col("key"), h.cast("long").alias("h"))
    # quantiles are doubles, so a range is named by the least place in it: that row is there, also beyond 2^53
    at = F.size(F.filter(places(cuts), lambda b: b <= F.col("place")))
    firsts = source.withColumn("place", place).groupBy(at).agg(F.min("place").alias("first"))
    bounds = sorted((r.first.key, r.first.h) for r in firsts.select("first").collect()) or [(0, 0)]
    limits = places(bounds)
    bucket = F.size(F.filter(limits, lambda b: b <= F.col("place"))) - 1
    # the first document of each range is also a guest behind the last one of the range before
    before = F.when(F.col("bucket") == 0, len(bounds) - 1).otherwise(F.col("bucket") - 1)
    home = F.struct(F.col("bucket"), F.lit(0).alias("guest"))
    visit = F.struct(before.alias("bucket"), F.lit(1).alias("guest"))
    first = F.array_contains(limits, F.col("place"))
    rows = source.withColumn("place", place).withColumn("bucket", bucket)
    rows = rows.withColumn("at", F.explode(F.when(first, F.array(home, visit)).otherwise(F.array(home))))
    rows = rows.select("key", "doc_id", "text", "at.bucket", "at.guest").repartitionById(len(bounds), "bucket")
    inside = Window.partitionBy("bucket").orderBy("guest", "key", F.xxhash64("text"), "text")
    rows = rows.withColumn("nth", F.row_number().over(inside)).withColumn("next", F.lead("text").over(inside))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n - half).cast("int")), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half))
    rows = rows.select(
        "bucket", "nth", "guest", "doc_id", n.cast("long").alias("n_chars"),
        F.explode(F.when(F.col("guest") == 0, F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("of")), F.struct(F.lit(1).alias("kind"), edited.alias("of"))))
                  .otherwise(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("of"))))).alias("x"))
    rows = rows.select("bucket", "nth", "guest", "doc_id", "n_chars", "x.kind", "x.of")
    rows = rows.withColumn("sha", F.when(F.col("kind") == 1, F.sha2("of", 256)))
    rows = counted(rows, "of", "terms").drop("of").withColumn("x", F.explode_outer("terms")).drop("terms")
    rows = rows.select("bucket", "nth", "kind", "guest", "doc_id", "n_chars", "sha", F.col("x.term").alias("term"), F.log(F.col("x.weight").cast("double")).alias("ln_s"))
    grouped = rows.groupBy("bucket", "nth", "kind", "guest", "doc_id", "n_chars", "sha").agg(*[sample(i).alias(f"s{i}") for i in range(SAMPLES)])
    has = F.array(*[F.col(f"s{i}") for i in range(SAMPLES)])
    grouped = grouped.select("bucket", "nth", "kind", "guest", "doc_id", "n_chars", "sha", has.alias("samples"))
    # a text is followed by its edited text, that by the next text
    step = Window.partitionBy("bucket").orderBy("nth", "kind")
    out = grouped.select(
        "*", F.lead("sha").over(step).alias("edited_sha256"), F.lead("samples").over(step).alias("edited"),
        F.lead("samples", 2).over(step).alias("following")).filter("kind = 0 AND guest = 0")
    return out.select(
        F.col("doc_id").alias(id_col), "n_chars", "edited_sha256", text_form(F.col("samples")).alias("fingerprint"),
        text_form(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("samples"), F.col("edited")).alias("near_edited"),
        likeness(F.col("samples"), F.col("following")).alias("near_next"))


def op3(spark, sf_dir):
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints(read(spark, sf_dir, "documents"))
