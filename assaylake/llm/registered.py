"""The registered queries of this package and the SQL of those that SQL can express.

Each query applies its operator with production parameters to the whole `documents` table and derives the columns that
are compared from the operator's results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm import (
    bpe_codec,
    domain_score,
    filter_audit,
    jaccard_join,
    license_scan,
    mixing,
    packing,
    perplexity,
    rans_store,
    spot_signatures,
    surrogates,
    token_counts,
    turn_trie,
)
from assaylake.llm.shipping import ship
from assaylake.session import fresh_path

#: Tokens that a training sequence holds.
SEQUENCE = 2048
#: Key of the registered query's surrogates. Real runs bring their own and keep it secret.
SURROGATE_KEY = "registered-query"


def vocabulary_path() -> str:
    """The vocabulary file of the registered queries, as installed on driver and executors."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so that no run profits from an earlier one."""
    cache = fresh_path(spark, "token-count-cache")
    counted = token_counts.count_tokens(documents(spark, sf_dir), cache, vocabulary_path())
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > SEQUENCE).alias("over_limit"))


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_codec.encode_documents(documents(spark, sf_dir), vocabulary_path())
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op3_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target are the documents labelled as of good quality."""
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    return domain_score.score(documents(spark, sf_dir), good)


def op4_license_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summarise(*license_scan.scan(documents(spark, sf_dir)))


def op5_rans_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "token-ids")
    rans_store.write_corpus(documents(spark, sf_dir), folder, vocabulary_path(), end=1)
    read = rans_store.read_corpus(spark, folder).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return rans_store.with_starts(read, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary_path(), SEQUENCE, end=0)


def op7_order_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(documents(spark, sf_dir))


def op8_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = spot_signatures.compare_edited(documents(spark, sf_dir))
    return compared.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        spot_signatures.fingerprint(F.col("signatures")).alias("fingerprint"),
        spot_signatures.fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op9_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.measure(documents(spark, sf_dir)).select(
        "doc_id", *perplexity.COUNTS, "base_failed", "kept", "language", "perplexity", "lowest", "highest"
    )


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced, _ = surrogates.replace(documents(spark, sf_dir), SURROGATE_KEY)
    return replaced.withColumn("n_chars", F.length("text").cast("bigint"))


def op11_existential_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_radix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return turn_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_bpe_codec": op2_bpe_codec,
    "op3_entropy_difference": op3_entropy_difference,
    "op4_license_votes": op4_license_votes,
    "op5_rans_store": op5_rans_store,
    "op6_bin_completion": op6_bin_completion,
    "op7_order_filters": op7_order_filters,
    "op8_spot_signatures": op8_spot_signatures,
    "op9_perplexity_rules": op9_perplexity_rules,
    "op10_surrogates": op10_surrogates,
    "op11_existential_audit": op11_existential_audit,
    "op12_radix_trie": op12_radix_trie,
    "op13_entropy_balancing": op13_entropy_balancing,
}

ORACLES: dict[str, str] = {"op11_existential_audit": filter_audit.AUDIT_SQL, "op12_radix_trie": turn_trie.TRIE_SQL}
