"""From documents to token ids: five stages over one corpus.

Each stage takes the documents that the one before kept, as a stored table, and returns the
columns of ``documents``; the last returns token ids. Toxic documents go, then all but one of
each group of near copies, then passages that repeat; what is left is mixed to the target
weights of its sources and encoded.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.llm import bpe, jaccard, mixing, repeats, toxicity
from tristrata.llm.queries import VOCABULARY, WEIGHTS
from tristrata.llm.storage import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from all labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    judged = toxicity.classify(docs.select(COLUMNS), labels, F.lit(False))
    return judged.where("predicted = 0").select(COLUMNS)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of near copies."""
    return jaccard.one_row_each(docs.select(COLUMNS)).select(COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that other documents have; a document of nothing else goes."""
    whole = docs.select(COLUMNS).withColumn("__whole", F.length("text"))
    left = repeats.remove_repeats(whole, **repeats.PASSAGE)
    emptied = (F.col("__whole") > 0) & (F.length("text") == 0)
    found = left.where(~F.coalesce(emptied, F.lit(False)))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out until sources have their shares, in random order."""
    return mixing.mix(docs.select(COLUMNS), WEIGHTS).select(COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, as little-endian 32-bit numbers, and how many there are."""
    path = public_tokenizers.path(VOCABULARY)
    return bpe.encode(docs.select(COLUMNS), path, public_tokenizers.PATTERN, packed=True)


STAGES = [
    ("toxicity", without_toxic),
    ("near_copies", one_of_near_copies),
    ("repeats", without_repeats),
    ("mixing", mixed),
    ("encoding", encoded),
]
#: SQL cannot express these stages; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
