"""One query for each operator, over its whole table, and their SQL."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.llm import (
    bpe,
    codes,
    embeddings,
    jaccard,
    lm,
    mixing,
    quality,
    repeats,
    search,
    sharding,
    toxicity,
    urls,
    warc,
)
from tristrata.llm.storage import stored

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = [f"shard-{k:02d}" for k in range(32)]
SHARD_SLOTS = 4093
#: Shares of the mixture; the other sources share the rest in proportion to their rows.
WEIGHTS = {"src0": 0.15, "src1": 0.1, "src2": 0.1, "src3": 0.05}
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.drop("text", "n_lines", "failed")


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(fold("doc_id") == 1, F.lit(False))
    return lm.score(documents(spark, sf_dir).select("doc_id", "text"), held_out)


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return repeats.repeat_counts(docs, passage=repeats.PASSAGE)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sharding.lookup_table(spark, SHARDS, SHARD_SLOTS)
    return sharding.place(documents(spark, sf_dir), table, "doc_id", ("text",), SHARD_SLOTS)


def fold(column: str, folds: int = 5) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held_out = F.coalesce(fold("doc_id") == 0, F.lit(False))
    return toxicity.classify(docs, labels, held_out).drop("text")


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return embeddings.near_duplicates(vectors)


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return urls.judge(pages, URL_RULES).drop("url")


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(documents(spark, sf_dir).select("doc_id", "text"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, repeated and shuffled, with the number and the place of each copy."""
    return stored(mixing.mix(documents(spark, sf_dir), WEIGHTS), "mixture")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN, packed=True, decoded="decoded")
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = search.build_index(documents(spark, sf_dir))
    return search.search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    archives = warc.write_archives(pages, compression="gzip")
    records = stored(warc.read_archives(spark, archives, payload=False), "warc-records")
    return warc.with_originals(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    books = codes.fit(vectors)
    coded = stored(codes.encode(vectors.select("vec_id", "label", "embedding"), books), "codes")
    return codes.with_group_error(coded).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_lm": op2_lm,
    "op3_repeats": op3_repeats,
    "op4_sharding": op4_sharding,
    "op5_toxicity": op5_toxicity,
    "op6_embeddings": op6_embeddings,
    "op7_urls": op7_urls,
    "op8_jaccard": op8_jaccard,
    "op9_mixing": op9_mixing,
    "op10_bpe": op10_bpe,
    "op11_search": op11_search,
    "op12_warc": op12_warc,
    "op13_codes": op13_codes,
}

ORACLE = {
    "op1_quality": quality.judged_sql("documents"),
    "op4_sharding": sharding.placed_sql(SHARDS, SHARD_SLOTS),
    "op9_mixing": mixing.mixed_sql(WEIGHTS),
    "op11_search": search.ranked_sql(),
    "op12_warc": warc.resolved_sql(),
    "op13_codes": codes.coded_sql(),
}
