"""Faceted text search over an inverted index.

Ours by choice: BM25 with the document id as tie-break, values of one facet are alternatives, facets add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiforge import storage
from lexiforge.functions.tokenizers import words
from lexiforge.schemas import PAGE_SEARCH

K1, B = 1.2, 0.75
#: Words that an index task holds at a time, some.
RUN = 200_000


def index(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(term, id, tf, positions, doc_len): one row per term and document.

    A document's rows come from its text alone, in Arrow batches, so that nothing is shuffled; only where an id has several texts
    are the words of all documents grouped.
    """
    rows = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("w"))
    if docs.groupBy(id_col).count().filter("count > 1").limit(1).count():
        rows = rows.withColumn("doc_len", F.size("w").cast("long"))
        rows = rows.select("id", "doc_len", F.posexplode("w").alias("pos", "term"))  # the length is taken below the explode, once a document
        return rows.groupBy("term", "id", "doc_len").agg(F.count("*").alias("tf"), F.array_sort(F.collect_list("pos")).alias("positions"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_postings, f"term string, id {kind}, doc_len long, tf long, positions array<int>")


def _postings(batches):
    """(id, words) to a row per term and document; some RUN words at a time."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False).astype("int64")
        ends = np.cumsum(lengths)
        done = 0
        while done < batch.num_rows:
            n = max(1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + RUN, "right")) - done)
            part, own = batch.slice(done, n), lengths[done : done + n]
            done += n
            if not own.sum():
                continue
            doc, coded = np.repeat(np.arange(n), own), part.column(1).flatten().dictionary_encode()
            place = np.arange(len(doc)) - np.repeat(np.cumsum(own) - own, own)
            key = doc * len(coded.dictionary) + coded.indices.to_numpy()
            order = np.argsort(key, kind="stable")  # places stay in order
            first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
            tf, at, docs = np.diff(np.append(first, len(doc))), order[first], pa.array(doc[order[first]])
            positions = pa.ListArray.from_arrays(pa.array(np.append(first, len(doc)).astype("int32")), pa.array(place[order].astype("int32")))
            term = coded.dictionary.take(coded.indices.take(pa.array(at)))
            made = pa.RecordBatch.from_arrays([term, part.column(0).take(docs), pa.array(own[doc[at]]), pa.array(tf.astype("int64")), positions], names=["term", "id", "doc_len", "tf", "positions"])
            yield made.take(pa.array(np.lexsort((place[at], tf))))  # equal positions side by side: as a table they take less


def lookup(docs: DataFrame, id_col: str, text_col: str, query: str) -> tuple[DataFrame, int, float]:
    """(postings of the query's terms, documents with a word, their mean length) straight from the texts, without the whole index."""
    terms = sorted({t for t in query.lower().split() if t})
    rows = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("w"))
    tf = lambda t: F.size("w") - F.size(F.array_remove("w", t))
    hits = F.array(*[F.struct(F.lit(t).alias("term"), tf(t).alias("tf")) for t in terms]).cast("array<struct<term:string,tf:bigint>>")
    # texts are read once; all that follows reads the narrow rows
    rows = storage.kept(rows.select("id", F.size("w").cast("long").alias("doc_len"), hits.alias("hits")), "postings").filter("doc_len > 0")
    n, mean = rows.agg(F.count("*"), F.avg("doc_len")).first()
    hits = rows.select("id", "doc_len", F.inline("hits")).filter("tf > 0")
    return hits.groupBy("term", "id", "doc_len").agg(F.sum("tf").alias("tf")), n, mean


def search(postings: DataFrame, docs: DataFrame, query: str, facets: dict | None = None, id_col: str = "id", sort: str | None = None, page: int = 1, size: int = PAGE_SEARCH, n_docs: int | None = None, mean_len: float | None = None) -> DataFrame:
    """One page of hits (all query terms) with score, place and total; an empty query has none.

    docs: (id_col, facet columns...), filtered by the facets before the join; sort: a column, descending with a leading -.
    """
    terms = [t for t in query.lower().split() if t]
    kept = docs
    for column, values in (facets or {}).items():
        kept = kept.filter(F.col(column).isin(*values)) if values else kept
    found = postings.filter(F.col("term").isin(*terms)) if terms else postings.filter(F.lit(False))
    stats = postings.select("id", "doc_len").distinct().agg(F.count("*").alias("n"), F.avg("doc_len").alias("mean"))
    df = found.groupBy("term").agg(F.count("*").alias("df"))
    rows = found.join(df, "term").crossJoin(F.broadcast(stats)) if n_docs is None else found.join(df, "term").withColumns({"n": F.lit(n_docs), "mean": F.lit(mean_len)})
    idf = F.ln(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("doc_len") / F.col("mean")))
    hits = rows.groupBy("id").agg(F.sum(part).alias("score"), F.count("*").alias("terms")).filter(F.col("terms") == len(set(terms)))
    hits = hits.select(F.col("id").alias(id_col), F.round("score", 6).alias("score")).join(kept, id_col)
    by = [F.desc("score")] if not sort else [F.desc(sort[1:]) if sort[0] == "-" else F.asc(sort)]
    total = hits.agg(F.count("*").alias("total"))
    return hits.orderBy(*by, id_col).offset((max(1, page) - 1) * size).limit(size).crossJoin(F.broadcast(total))


def facet_counts(docs: DataFrame, column: str, order: str | None = None) -> DataFrame:
    """(value, n) of non-empty facet values, sorted by the value or by the least `order` of its documents (a rank)."""
    key = F.min(order if order else column)
    rows = docs.filter(F.coalesce(F.col(column).cast("string"), F.lit("")) != "").groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"), key.alias("__key"))
    return rows.orderBy("__key", "value").drop("__key")
