"""Training-log text back to rows."""

from pyspark.sql import functions as F

# Fixed line shapes of the log:
#   Rank r, Epoch e, Batch b, Loss x
#   Rank r, PID p with n samples, Epoch e, Batch b, Loss x
#   Rank r - Epoch e, Loss x, Accuracy y%
NUMBER = r"(-?[0-9.]+(?:[eE][-+]?[0-9]+)?|nan|-?inf)"
LINE = (
    r"^.*?Rank ([0-9]+)(?:"
    rf"(?:, PID [0-9]+ with ([0-9]+) samples)?, Epoch ([0-9]+), Batch ([0-9]+), Loss {NUMBER}"
    rf"| - Epoch ([0-9]+), Loss {NUMBER}, Accuracy {NUMBER}%"
    r").*$"
)
MARK = "\u0001"


def parse_training_log(lines, value="value"):
    """(kind, rank, epoch, batch_idx, n_samples, loss, accuracy); lines of no known shape are left out.

    kind is "batch" or "epoch". Columns a shape does not carry are null. One replacement pulls all fields of a
    line out at once.
    """
    others = [c for c in lines.columns if c != value]
    fields = F.regexp_replace(value, LINE, MARK.join(["", "$1", "$2", "$3", "$4", "$5", "$6", "$7", "$8"]))
    found = lines.filter(F.contains(value, F.lit("Rank "))).select(
        *others, F.split(fields, MARK).alias("_f")
    ).filter(F.size("_f") == 9)

    def field(i):
        return F.nullif(F.get("_f", F.lit(i)), F.lit(""))

    return found.select(
        *others,
        F.when(field(4).isNotNull(), "batch").otherwise("epoch").alias("kind"),
        field(1).cast("int").alias("rank"),
        F.coalesce(field(3), field(6)).cast("int").alias("epoch"),
        field(4).cast("long").alias("batch_idx"),
        field(2).cast("int").alias("n_samples"),
        F.coalesce(field(5), field(7)).cast("double").alias("loss"),
        field(8).cast("double").alias("accuracy"),
    )


def read_training_log(spark, path):
    return parse_training_log(spark.read.text(path))
