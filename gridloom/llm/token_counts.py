"""Token counts by a two-tier lookup on the map side.

Tier one is a broadcast hash table: pre-token -> number of tokens, for pre-tokens frequent in a bounded sample of rows.
Tier two is a table inside the task: misses are encoded once and remembered. Counts add up over pre-tokens because no
piece of the model crosses a pre-token's edge, which is checked when the model is loaded. Neither pre-tokens nor
texts are shuffled (the counts of the sampled rows are). The tables are caches; results don't depend on them.
"""

import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from gridloom.llm.common import read, slices, texts

#: The model's sign for a space.
SPACE = "▁"
#: Spaces with the characters behind them, up to the next space or line end.
PRE_TOKEN = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


def load(path):
    """The model; an error if counts of pre-tokens would not add up."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    crossing = re.compile(f"[^{SPACE}]{SPACE}|.\n|\n.", re.DOTALL)
    for i in range(model.get_piece_size()):
        if crossing.search(model.id_to_piece(i)):
            raise ValueError(f"piece {i} crosses a pre-token's edge")
    plain = "a  b\tc\n \nd eﬁ"
    if model.encode(plain, out_type=str)[:1] != [SPACE + "a"] or model.decode(model.encode(plain)) != plain:
        raise ValueError("the model must add one space in front and leave characters as they are")
    return model


def pre_tokens(text):
    return PRE_TOKEN.findall(SPACE + text.replace(" ", SPACE)) if text else []


class Lengths(dict):
    """Pre-token -> number of tokens; what the frequent table lacks is encoded and remembered."""

    def __init__(self, model, frequent, most=500_000):
        super().__init__(frequent)
        self.model, self.frequent, self.most = model, frequent, most
        # in front of a pre-token: the added space and a line end, which never join with it
        self.front = len(model.encode("\n", num_threads=1))

    def learn(self, rows):
        """Encodes all unknown pre-tokens of some texts in one call."""
        if len(self) > self.most:
            self.clear()
            self.update(self.frequent)
        new = list({w for row in rows for w in row if w not in self})
        for w, ids in zip(new, self.model.encode(["\n" + w for w in new], num_threads=1)):
            self[w] = len(ids) - self.front


def frequent_lengths(docs, model_path, sample_rows=4000, entries=65_536):
    """The broadcast tier: token numbers of at most `entries` pre-tokens, those most frequent in about sample_rows rows."""
    n = docs.count()

    def count(batches):
        for part in slices(batches):
            found = Counter(w for t in texts(part) for w in pre_tokens(t))
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["w", "n"])

    sample = docs.sample(fraction=min(1.0, sample_rows / max(n, 1)), seed=7)
    top = (
        sample.mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "w").limit(entries).select("w")
    )
    lengths = Lengths(load(model_path), {})
    lengths.learn([[r.w for r in top.collect()]])
    return dict(lengths)


def token_counts(docs, model_path, id_col="doc_id", text_col="text", sample_rows=4000, entries=65_536):
    """id_col, n_bytes (UTF-8) and n_tokens of every text by a sentencepiece model; null counts as empty, which has none.

    model_path: a file that every machine has. Repeated rows are counted each; other columns are left out.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = docs.sparkSession.sparkContext.broadcast(
        frequent_lengths(source.select("text"), model_path, sample_rows, entries))

    def run(batches):
        lengths = Lengths(load(model_path), table.value)
        for part in slices(batches):
            rows = [pre_tokens(t) for t in texts(part)]
            lengths.learn(rows)
            n = [sum(map(lengths.__getitem__, row)) for row in rows]
            size = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), size, pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return source.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumnRenamed("doc_id", id_col)


def op4(spark, sf_dir):
    """Token numbers of all documents, and which exceed 4096 tokens."""
    import public_tokenizers

    counts = token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)
