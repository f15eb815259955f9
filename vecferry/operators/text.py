"""BM25 over whole texts: ranking, and encoding as sparse vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecferry.functions.predicates import words
from vecferry.operators.scoring import Sparse, matches
from vecferry.session import written

K1 = 1.2
B = 0.75
ALL = ""  # stands for the whole corpus among the terms
FREQUENT = 500_000  # terms that are broadcast
LONGEST = 128  # bytes of a broadcast term


def tokenized(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    tokens = documents.select(id_column, words(F.col(text)).alias("words"))
    return tokens.withColumn("n_words", F.size("words"))


def each_word(tokens: DataFrame, kept: list[str], array: Column) -> DataFrame:
    """One row per array element.

    The outer form keeps Spark from adding a filter on the array below, which would split every text
    into words once more (and ahead of a shuffle that is there to spread that work).
    """
    return tokens.select(*kept, F.explode_outer(array).alias("term")).filter(F.col("term").isNotNull())


def length_norm(mean_words: Column, k1: float = K1, b: float = B) -> Column:
    return k1 * (1 - b + b * F.col("n_words") / mean_words)


def inverse_frequency(n_documents: Column, document_frequency: Column) -> Column:
    return F.log(1 + (n_documents - document_frequency + 0.5) / (document_frequency + 0.5))


def fits_broadcast(terms: DataFrame) -> bool:
    size = terms.agg(F.count("*").alias("rows"), F.sum(F.octet_length("term")).alias("bytes")).first()
    return size.rows <= FREQUENT and (size.bytes or 0) <= FREQUENT * LONGEST


def term_statistics(postings: DataFrame) -> DataFrame:
    """Documents per term and their total words. The row of the empty word has those of the whole corpus."""
    return postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("n_words").alias("total_words"))


def corpus_size(statistics: DataFrame) -> tuple[Column, Column]:
    """Number of documents and mean words per document."""
    whole = statistics.filter(F.col("term") == ALL)
    return whole.select("df").scalar(), whole.select(F.col("total_words") / F.col("df")).scalar()


def query_terms(queries: DataFrame, text: str) -> DataFrame:
    return each_word(queries, ["query_id"], F.array_distinct(words(F.col(text))))


def as_lists(weighted: DataFrame, key: str) -> DataFrame:
    """One sparse vector per key; its size is the distinct words of that one text."""
    entries = F.array_sort(F.collect_list(F.struct("term", "weight")))
    return weighted.groupBy(key).agg(entries.alias("e")).select(
        key, F.col("e.term").alias("terms"), F.col("e.weight").alias("weights")
    )


def term_counts(tokens: DataFrame, id_column: str) -> DataFrame:
    """``<id>, n_words, term, tf``: the words of each document counted inside its row, so nothing is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            words = lists.flatten().dictionary_encode()
            codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            most = max(len(words.dictionary), 1)
            pair, tf = np.unique(np.repeat(np.arange(len(lists)), lengths) * most + codes, return_counts=True)
            row, code = (pa.array(x) for x in np.divmod(pair, most))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column).take(row), batch.column("n_words").take(row), words.dictionary.take(code), pa.array(tf)],
                names=[id_column, "n_words", "term", "tf"])

    kind = tokens.schema[id_column].dataType.simpleString()
    rows = tokens.select(id_column, "n_words", "words")
    return rows.mapInArrow(count, f"`{id_column}` {kind}, n_words int, term string, tf long")


def written_postings(documents: DataFrame, id_column: str, text: str, terms: DataFrame | None = None) -> DataFrame:
    """``<id>, n_words, term, tf``, written once, so that texts are cut into words once.

    Every document also has the empty word, which no text contains: it stands for the corpus in the statistics. With
    ``terms`` only those are kept: the others go where the text is read, if the asked ones are few enough to broadcast.
    """
    tokens = tokenized(documents, id_column, text).withColumn("words", F.array_append("words", F.lit(ALL)))
    if terms is None:
        return written(term_counts(tokens, id_column), "postings")
    every = documents.sparkSession.range(1).select(F.lit(ALL).alias("term"))
    asked = written(terms.select("term").distinct().unionByName(every), "asked")
    words = each_word(tokens, [id_column, "n_words"], F.col("words"))
    kept = words.join(F.broadcast(asked) if fits_broadcast(asked) else asked, "term", "left_semi")
    return written(kept.groupBy(id_column, "n_words", "term").agg(F.count("*").alias("tf")), "postings")


def saturated(mean_words: Column) -> Column:
    """What ``tf`` occurrences of a word weigh in a document of ``n_words``, before its inverse frequency."""
    return F.col("tf") * (K1 + 1) / (F.col("tf") + length_norm(mean_words))


def bm25_search(
    documents: DataFrame, queries: DataFrame, k: int, id_column: str = "doc_id", text: str = "text",
    query_text: str = "text", broadcast: bool | None = None,
) -> DataFrame:
    """Best k documents per query, by their distinct words weighted by inverse document frequency.

    One pass over the corpus. Words that no query asks for are dropped where the text is read; what is shuffled is one
    row per document and asked word that it has, never a text.
    """
    terms = query_terms(queries, query_text)
    postings = written_postings(documents, id_column, text, terms)
    statistics = written(term_statistics(postings), "terms")
    n_documents, mean_words = corpus_size(statistics)
    weighted = terms.join(statistics, "term").withColumn("weight", inverse_frequency(n_documents, F.col("df")))
    scored = postings.filter(F.col("term") != ALL).withColumn("weight", saturated(mean_words))
    items = as_lists(scored.select(id_column, "term", "weight"), id_column)
    return matches(items, as_lists(weighted, "query_id"), Sparse(), id_column, k=k, broadcast=broadcast, derived=True)


def bm25_weights(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Weight of every word of every document, one row each.

    Words are looked up in two parts: the ``FREQUENT`` most common ones, which make up nearly all postings, are
    broadcast; the postings of the others, none of which is common, are shuffled.
    """
    every = written_postings(documents, id_column, text)
    statistics = written(term_statistics(every), "terms")
    n_documents, mean_words = corpus_size(statistics)
    postings = every.filter(F.col("term") != ALL)
    terms = statistics.filter(F.col("term") != ALL).select("term", "df")
    if fits_broadcast(statistics):
        found = postings.join(F.broadcast(terms), "term")
    else:
        short = terms.filter(F.octet_length("term") <= LONGEST)
        common = written(short.orderBy(F.col("df").desc(), "term").limit(FREQUENT), "frequent")
        rest = terms.join(F.broadcast(common.select("term")), "term", "left_anti")
        others = postings.join(F.broadcast(common.select("term")), "term", "left_anti").join(rest, "term")
        found = postings.join(F.broadcast(common), "term").unionByName(others)
    return found.select(
        id_column, "term", (inverse_frequency(n_documents, F.col("df")) * saturated(mean_words)).alias("weight")
    )


def sparse_vectors(weights: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Sparse vector table: one term -> weight map per document."""
    lists = as_lists(weights, id_column)
    return lists.select(id_column, F.map_from_arrays("terms", "weights").alias("sparse"))


def sparse_search(
    vectors: DataFrame, queries: DataFrame, k: int, id_column: str = "doc_id", broadcast: bool | None = None
) -> DataFrame:
    """Best k by inner product of sparse maps; ``queries`` has query_id, terms, weights."""
    items = vectors.select(id_column, F.map_keys("sparse").alias("terms"), F.map_values("sparse").alias("weights"))
    return matches(items, queries, Sparse(), id_column, k=k, broadcast=broadcast, derived=True)
