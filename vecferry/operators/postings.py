"""Postings of a corpus, stored once and searched many times.

A row per document and word, ``<id>, n_words, term, tf``, laid out by bucket of the word and sorted by it within files. A
search reads the buckets of its words alone, and in them the row groups that may have those words. Beside them lie the
number of documents and words of every addition, so documents can be added without touching what is there. How many
documents have a word is counted from its postings, all of which a search for it reads anyway.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecferry.operators import text as tx
from vecferry.operators.scoring import Sparse, matches
from vecferry.session import written
from vecferry.sources.target import balanced, hash_bucket

BUCKET = "bucket"
BUCKETS = 64
FEW_TERMS = 100


def add_documents(documents: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> None:
    """Adds documents that are not there yet; ``buckets`` is that of the first addition. A text is cut into words once."""
    spark = documents.sparkSession
    tokens = tx.tokenized(documents, id_column, text).withColumn("words", F.array_append("words", F.lit(tx.ALL)))
    counted = written(tx.term_counts(tokens, id_column), "term-counts")
    rows = counted.filter(F.col("term") != tx.ALL).withColumn(BUCKET, hash_bucket(F.col("term"), buckets))
    balanced(rows, BUCKET).sortWithinPartitions(BUCKET, "term").write.mode("append").partitionBy(BUCKET).parquet(f"{path}/postings")
    # The corpus row comes last: a search uses no addition before it is whole.
    whole = counted.filter(F.col("term") == tx.ALL).agg(F.count("*").alias("n_documents"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("total_words"))
    whole.withColumn("buckets", F.lit(buckets)).coalesce(1).write.mode("append").parquet(f"{path}/corpus")


def corpus_size(spark: SparkSession, path: str) -> tuple[int, float, int]:
    """Documents, mean words of one, and buckets."""
    found = spark.read.parquet(f"{path}/corpus").agg(F.sum("n_documents").alias("n"), F.sum("total_words").alias("words"), F.min("buckets").alias("low"), F.max("buckets").alias("high")).first()
    if found.low != found.high:
        raise ValueError(f"additions to {path} have {found.low} and {found.high} buckets")
    return found.n, (found.words / found.n if found.n else 0.0), found.low


def postings_of(spark: SparkSession, path: str, terms: DataFrame, buckets: int) -> DataFrame:
    """The postings of these terms; only their buckets are read."""
    asked = written(terms.select("term").distinct(), "asked-terms")
    wanted = [r[0] for r in asked.select(hash_bucket(F.col("term"), buckets)).distinct().collect()]  # at most ``buckets`` numbers
    stored = spark.read.parquet(f"{path}/postings").filter(F.col(BUCKET).isin(wanted))
    few = asked.limit(FEW_TERMS + 1).collect()
    if len(few) <= FEW_TERMS:  # as literals they reach the statistics of the row groups
        stored = stored.filter(F.col("term").isin([r.term for r in few]))
    else:
        stored = stored.join(F.broadcast(asked) if tx.fits_broadcast(asked) else asked, "term", "left_semi")
    return stored.drop(BUCKET)


def search_stored(spark: SparkSession, path: str, queries: DataFrame, k: int, id_column: str = "doc_id", query_text: str = "text") -> DataFrame:
    """Best k documents per query by BM25, as ``bm25_search`` finds them in the texts."""
    n_documents, mean_words, buckets = corpus_size(spark, path)
    terms = tx.query_terms(queries, query_text)
    postings = postings_of(spark, path, terms, buckets)
    df = postings.groupBy("term").agg(F.count("*").alias("df"))
    weighted = terms.join(df, "term").withColumn("weight", tx.inverse_frequency(F.lit(n_documents), F.col("df")))
    scored = postings.withColumn("weight", tx.saturated(F.lit(mean_words)))
    items = tx.as_lists(scored.select(id_column, "term", "weight"), id_column)
    return matches(items, tx.as_lists(weighted, "query_id"), Sparse(), id_column, k=k, derived=True)
