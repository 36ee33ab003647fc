"""A training-text pipeline: each stage reads all that the one before it kept, and returns the columns of documents.

The last stage returns token ids instead.
"""

import uuid

from pyspark import cloudpickle
from pyspark.sql import functions as F

import gridloom
from gridloom.llm import bpe, contamination, near_dup, substrings, toxicity
from gridloom.llm.common import read
from gridloom.session import shared_dir

cloudpickle.register_pickle_by_value(gridloom)


def drop_toxic(spark, docs, sf_dir):
    """Documents that the segment scores don't call toxic; the model is learned from the labels of the documents at hand."""
    return toxicity.score(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")), keep=True)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document, the one with the smallest id, of each near-duplicate component; of rows with its id all."""
    out = near_dup.near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(out, "doc_id", "left_anti").select(docs.columns)


def drop_repeats(spark, docs, sf_dir):
    """Documents without the words that repeat earlier ones; a changed text is its kept words joined by one space. Null texts keep their n_chars."""
    n_chars = F.coalesce(F.length("text").cast("long"), "n_chars")
    return substrings.without_repeats(docs).withColumn("n_chars", n_chars).select(docs.columns)


def drop_contaminated(spark, docs, sf_dir):
    """Documents in which less than 1 of 20 words lies in a benchmark window."""
    return contamination.clean(docs, read(spark, sf_dir, "benchmark"))


def encode(spark, docs, sf_dir):
    """Token ids of every document by byte-level BPE, decoded again."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    done = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path)
    return done.select("doc_id", "ids", *bpe.digests())


STAGES = [
    ("toxicity", drop_toxic), ("MinHash near-dedup", drop_near_duplicates), ("substring dedup", drop_repeats),
    ("benchmark decontamination", drop_contaminated), ("byte-level BPE", encode),
]

#: Toxicity scores and BPE have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of sf_dir, each written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
