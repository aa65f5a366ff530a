"""Token counts with a digest cache: normalised content and tokenizer version find stored counts, misses are encoded."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.encoding import encoder, steps
from assaylake.llm.vocabulary import version
from assaylake.session import settle

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens bigint"


def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one space, none stays at the ends. Texts that agree in this have the same
    tokens, since no token holds or depends on white space. Nothing else is folded: upper case matters in the special
    strings and under combining marks."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+", " "))


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def _count(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            digests, texts = batch.column("digest"), batch.column("text")
            for at, n in steps(texts):
                counts = pa.array(own.count(texts.slice(at, n)))
                yield pa.RecordBatch.from_arrays([digests.slice(at, n), counts], ["digest", "n_tokens"])

    return count


def open_cache(spark, cache_path: str) -> DataFrame:
    """The stored counts; an empty append creates the table, so that a first run needs no other path."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache_path)


def count_tokens(docs: DataFrame, cache_path: str, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and digest of every row; counts that the cache lacks are added to it.

    Null and empty texts have 0 tokens. Rows with a null id, repeated ids and repeated rows are all kept. Other columns
    are ignored, whatever their names. Of equal contents one is encoded: the row with the smallest id carries its text
    through the one shuffle of texts, whose other side is narrow and never broadcast unless Spark measures it as small.
    A job that is run again finds the counts it has stored; storing a count twice does no harm.
    """
    spark, tokenizer = docs.sparkSession, version(vocabulary_path)
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("raw", F.xxhash64("text"))
    keyed = settle(
        rows.select("doc_id", "raw", F.octet_length("text").cast("long").alias("n_bytes"), content_digest(F.col("text")).alias("digest")),
        "digests",
    )
    stored = open_cache(spark, cache_path).where(F.col("tokenizer") == tokenizer).select("digest")
    first = keyed.groupBy("digest").agg(F.min(F.struct("doc_id", "raw")).alias("first"))
    misses = first.join(stored, "digest", "left_anti").select("digest", F.col("first.doc_id").alias("id_"), F.col("first.raw").alias("raw_"))
    wanted = rows.join(misses.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("raw") == F.col("raw_")))
    counted = wanted.select("digest", "text").mapInArrow(_count(vocabulary_path), "digest binary, n_tokens bigint")
    fresh = counted.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    fresh.select("digest", F.lit(tokenizer).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)
    held = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == tokenizer)
    held = held.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return keyed.join(held, "digest", "left").select("doc_id", "n_bytes", "n_tokens", F.lower(F.hex("digest")).alias("digest"))
