"""Full-text, vector and hybrid ranking over postings tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from ..functions import norm, similarity
from ..shared import keep_until_exit, spread, write_table

#: Constants of BM25; one place for them.
K1, B = 1.2, 0.75
# fixed values: endings that the light stemmers cut, longest first
ENDINGS = {"fr": "issements issement atrices atrice ements ement euses euse ances ance ences ence ables able istes iste ions ion aient erait erons erez eront ais ait ant ees ee er es e s".split(), "en": "ational ization fulness ousness iveness ements ement ingly edly ness ings ing ies ed ly es s".split()}


def tokens(c: Column) -> Column:
    """Runs of letters and digits, lower case, without accents."""
    return norm.words(c)


def stem(token: Column, lang: str = "fr") -> Column:
    """One ending cut if three letters or more stay."""
    alt = "|".join(sorted(ENDINGS[lang], key=len, reverse=True))
    return F.regexp_replace(token, rf"^(.{{3,}}?)(?:{alt})$", "$1")


def postings(docs: DataFrame, id_col: str, text_col: str, lang: str | None = None) -> DataFrame:
    """``(term, id, tf)`` and, through ``lengths``, the length of each document."""
    t = tokens(F.col(text_col))
    rows = spread(docs.select(F.col(id_col).alias("id"), F.col(text_col))).select("id", F.explode(t).alias("term"))
    if lang:
        rows = rows.withColumn("term", stem(F.col("term"), lang))
    return rows.groupBy("term", "id").agg(F.count("*").alias("tf"))


def lengths(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.size(tokens(F.col(text_col))).alias("len")).where("len > 0")


def write_index(docs: DataFrame, path: str, id_col: str, text_col: str, filters: list[str], meta: list[str]) -> dict[str, DataFrame]:
    """An index as tables under ``path``: ``postings(term, id, tf)`` in order of terms, so that a query's terms are all
    that is read of them, and ``documents(id, len, filters, meta)``; registered for deletion at exit."""
    spark = docs.sparkSession
    post = postings(docs, id_col, text_col).repartitionByRange("term").sortWithinPartitions("term", "id")
    rows = docs.select(F.col(id_col).alias("id"), F.size(tokens(F.col(text_col))).alias("len"), *filters, *meta)
    out = {}
    for name, df in (("postings", post), ("documents", rows)):
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        keep_until_exit(spark, f"{path}/{name}")
        out[name] = spark.read.schema(df.schema).parquet(f"{path}/{name}")
    return out


def match(post: DataFrame, terms: list[str]) -> DataFrame:
    """Documents that hold all terms."""
    terms = list(dict.fromkeys(terms))
    return post.where(F.col("term").isin(terms)).groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") == len(terms)).select("id")


def bm25(docs: DataFrame, id_col: str, text_col: str, terms: list[str], every: bool = False) -> DataFrame:
    """``(id, score)`` of documents with any (or every) term; only the query's postings are built."""
    terms = list(dict.fromkeys(terms))
    texts = spread(docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    # inside a lambda the tokens are one value, made once; as a column they would be made anew for every use
    counted = lambda t: F.struct(F.size(t).alias("len"), F.array(*[F.struct(F.lit(q).alias("term"), (F.size(t) - F.size(F.array_remove(t, q))).alias("tf")) for q in terms]).alias("hits"))
    base = texts.select("id", F.transform(F.array(tokens(F.col("text"))), counted)[0].alias("c"))
    # texts are tokenised once for the statistics and the scores; no filter is pushed below that
    base = write_table(base, "hits").select("id", "c.len", "c.hits").where("len > 0")
    stats = base.agg(F.count("*").alias("n_docs"), F.avg("len").alias("avg_len"), *[F.count_if(F.col("hits")[k]["tf"] > 0).alias(f"df{k}") for k in range(len(terms))])
    rows = base.where(F.exists("hits", lambda h: h["tf"] > 0)).crossJoin(F.broadcast(stats))  # one row on the right
    score = F.lit(0.0)
    for k in range(len(terms)):
        tf, df = F.col("hits")[k]["tf"], F.col(f"df{k}")
        idf = F.log(1 + (F.col("n_docs") - df + 0.5) / (df + 0.5))
        score = score + F.when(tf > 0, idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("len") / F.col("avg_len")))).otherwise(0.0)
    if every:
        rows = rows.where(F.forall("hits", lambda h: h["tf"] > 0))
    return rows.select("id", score.alias("score"))


def whole_words(terms: list[str]) -> str:
    """Pattern of whole words, whatever their case; letters and marks of every script are parts of words."""
    alt = "|".join(re.escape(t) for t in terms)
    return rf"(?iu)(?<![\p{{L}}\p{{M}}\p{{N}}_])({alt})(?![\p{{L}}\p{{M}}\p{{N}}_])"


def highlight(c: Column, terms: list[str], sign: str = "**") -> Column:
    """Whole words of the query between signs, whatever their case."""
    return F.regexp_replace(c, whole_words(terms), f"{sign}$1{sign}")


#: Query vectors that are compared with all rows in one pass; bounds what is sent to the workers.
BLOCK = 4096


def cosine_top(vectors: DataFrame, queries: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """``(query, id, score, rank)``: the ``k`` nearest others of each query vector, exactly; ties to the smaller id.

    ``queries`` is a stated set, taken in blocks: one pass over the vectors for each block, in which every batch keeps
    its best ``k`` of each query, so that little is moved whatever the number of rows.  Null and zero vectors are
    nobody's neighbours and have none.
    """
    spark = vectors.sparkSession
    parts, now = [], []

    def one(rows: list) -> DataFrame:
        sent = spark.sparkContext.broadcast(([r.id for r in rows], np.array([r.vector for r in rows], float)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, q = sent.value
            q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
            for b in batches:
                ids, v = b.column(0).to_numpy(), np.array(b.column(1).to_pylist(), float).reshape(b.num_rows, -1)
                size = np.linalg.norm(v, axis=1) if b.num_rows else np.zeros(0)
                ids, v = ids[size > 0], v[size > 0] / size[size > 0][:, None]
                if not len(ids):
                    continue
                score = q @ v.T
                out: list[tuple[int, int, float]] = []
                for n, row in zip(names, score):
                    row = np.where(ids == n, -np.inf, row)
                    edge = np.partition(row, -min(k, len(row)))[-min(k, len(row))]
                    at = np.flatnonzero(row >= edge)
                    at = at[np.lexsort((ids[at], -row[at]))][:k]
                    out += [(n, int(ids[j]), float(row[j])) for j in at if row[j] > -2]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64()))], names=["query", "id", "score"])

        return vectors.where("vector is not null").select(F.col("id").cast("long").alias("id"), "vector").mapInArrow(run, "query long, id long, score double")

    for r in queries.where("vector is not null").select(F.col("id").cast("long").alias("id"), "vector").toLocalIterator():
        if any(r.vector):
            now.append(r)
        if len(now) == block:
            parts.append(one(now))
            now = []
    if now:
        parts.append(one(now))
    if not parts:
        return spark.createDataFrame([], "query long, id long, score double, rank int")
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    w = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


#: Rows that the lists of an index are fitted on, at most.
FIT_ROWS = 20_000


class Lists:
    """Inverted lists of vectors: centroids from a bounded sample, and how many lists a query must visit.

    ``visits`` is the smallest number that reaches the wanted recall for queries of the sample against the sample.
    """

    def __init__(self, sample: np.ndarray, k: int, recall: float = 0.97, seed: int = 7, rows: int = 0):
        rng = np.random.default_rng(seed)
        unit = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-12)
        n = len(unit)
        # as many lists as the square root of the rows, as far as the sample can tell them apart
        lists = int(np.clip(round(max(n, rows) ** 0.5), 1, max(n // 5, 1)))
        c = unit[rng.choice(n, lists, replace=False)]
        for _ in range(12):
            own = (unit @ c.T).argmax(1)
            for j in range(lists):
                if (own == j).any():
                    c[j] = unit[own == j].mean(0)
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        self.centroids = c
        own = (unit @ c.T).argmax(1)
        ask = unit[rng.choice(n, min(n, 200), replace=False)]
        near = np.argsort(-(ask @ unit.T), axis=1)[:, : k + 1]
        order = np.argsort(-(ask @ c.T), axis=1)
        place = np.argsort(order, axis=1)  # when each list is visited
        seen = np.sort(np.take_along_axis(place, own[near], axis=1).ravel())
        self.visits = int(seen[min(len(seen) - 1, int(np.ceil(recall * len(seen))) - 1)]) + 1 if n else 1

    def nearest(self, v: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(-(v @ self.centroids.T), axis=1)[:, :n]


def knn(vectors: DataFrame, queries: DataFrame, k: int, recall: float = 0.97) -> DataFrame:
    """``(query, id, score, rank)``: approximate nearest neighbours by inverted lists, exact scores inside the lists.

    The lists are fitted on at most ``FIT_ROWS`` rows; every row with a vector is indexed.
    """
    n = vectors.count()
    part = vectors.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, FIT_ROWS / max(n, 1))) + 1).limit(FIT_ROWS)
    sample = np.array([r.vector for r in part.where("vector is not null").select("vector").toLocalIterator()], float)
    index = vectors.sparkSession.sparkContext.broadcast(Lists(sample, k, recall, rows=n) if len(sample) else None)

    def lists_of(visits: int | None):
        @F.arrow_udf(ArrayType(IntegerType()))
        def run(b: pa.Array) -> pa.Array:
            v = np.array([x or [0.0] * index.value.centroids.shape[1] for x in b.to_pylist()], float)
            return pa.array(index.value.nearest(v, visits or index.value.visits).tolist(), pa.list_(pa.int32()))

        return run

    if not len(sample):
        return queries.select(F.col("id").alias("query"), "id", F.lit(0.0).alias("score"), F.lit(1).alias("rank")).limit(0)
    kept = vectors.where("vector is not null").select("id", F.col("vector").alias("v"), F.explode(lists_of(1)(F.col("vector"))).alias("list"))
    asked = queries.where("vector is not null").select(F.col("id").alias("query"), F.col("vector").alias("q"), F.explode(lists_of(None)(F.col("vector"))).alias("list"))
    scored = kept.join(asked, "list").where("id <> query").select("query", "id", similarity.cosine(F.col("v"), F.col("q")).alias("score")).where("score is not null")
    w = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def recall_of(found: DataFrame, exact: DataFrame) -> DataFrame:
    """``(query, recall)``: the share of each query's exact neighbours that were found."""
    hit = found.select("query", "id", F.lit(1).alias("hit"))
    return exact.select("query", "id").join(hit, ["query", "id"], "left").groupBy("query").agg((F.count("hit") / F.count("*")).alias("recall"))


def hybrid(text_scores: DataFrame, vector_scores: DataFrame, text_weight: float = 0.3, k: int = 10) -> DataFrame:
    """Weighted sum over documents that either ranking has; a missing score is 0."""
    rows = text_scores.select("id", F.col("score").alias("t")).join(vector_scores.select("id", F.col("score").alias("v")), "id", "full_outer")
    return rows.select("id", (text_weight * F.coalesce("t", F.lit(0.0)) + (1 - text_weight) * F.coalesce("v", F.lit(0.0))).alias("score")).orderBy(F.desc("score"), "id").limit(k)


def with_cache(docs: DataFrame, cache: DataFrame, model: str) -> tuple[DataFrame, DataFrame]:
    """Documents with their cached vector, and those that are not in the cache for this model."""
    c = cache.where(F.col("model") == model).select("content_hash", "vector")
    return docs.join(c, "content_hash"), docs.join(c.select("content_hash"), "content_hash", "left_anti")


def embed(docs: DataFrame, text_col: str, embedder, most: int = 22_500) -> DataFrame:
    """``(content_hash, vector)`` of the distinct texts, cut to ``most`` characters for the model, by a given callable."""
    import pandas as pd

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame({"content_hash": pdf.content_hash, "vector": embedder([t[:most] for t in pdf.text])})

    rows = docs.select(F.sha2(F.col(text_col), 256).alias("content_hash"), F.col(text_col).alias("text")).where("text is not null").dropDuplicates(["content_hash"])
    return rows.mapInPandas(run, "content_hash string, vector array<float>")


def facets(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(facet, value, n)`` for each column; values nobody has are not there."""
    one = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns])).alias("f")
    return df.select(one).select("f.*").where("value is not null").groupBy("facet", "value").agg(F.count("*").alias("n"))


def site_search(docs: DataFrame, id_col: str, text_col: str, terms: list[str], filters: dict[str, str], page: int = 1, size: int = 10) -> DataFrame:
    """One page of the ranked documents that hold all terms and pass the filters; without terms, all that pass, by id."""
    for c, v in filters.items():
        docs = docs.where(F.col(c) == v)
    ranked = bm25(docs, id_col, text_col, terms, every=True) if terms else docs.select(F.col(id_col).alias("id"), F.lit(0.0).alias("score"))
    top = ranked.orderBy(F.desc("score"), "id").limit(page * size)
    w = Window.orderBy(F.desc("score"), "id")  # over at most page * size rows
    return top.withColumn("rank", F.row_number().over(w)).where(F.col("rank") > (page - 1) * size)
