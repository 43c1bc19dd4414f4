"""Mixing sources to target weights (problem 9): soft membership, rates by projected gradient, whole repeats.

Method.  A document with a listed source belongs to it; one without a source belongs to all listed ones, each with
the posterior of a naive Bayes classifier fitted on labelled documents; one of an unlisted source stays out.  Rates
(how often a document is used) are nonnegative and at most the cap of its sources; projected-gradient least squares
fits them so that the expected tokens of every source match its share of the total.  Documents of equal membership
have equal gradients, hence equal rates: memberships are kept in ``1 / GRAIN`` steps, so the gradient works on sums
over all documents in a table whose size is bounded whatever the corpus.  Rates become whole repeats by bins of a
hash of the id: of each source the bins are taken once more whose tokens add up to what its fitted rate gives, and to
what the whole repeats of documents of several sources left over.

The total.  The largest total for which all sources with documents reach their shares, but no less than
``LEAST_FILL`` of the tokens there are; sources that cannot reach their share of that are used up to their cap, the
others keep their proportions, and the report shows the shares reached.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import spread, write_table
from . import encoding, shingles

#: Labelled documents that the classifier is fitted on, about and at most: those whose hashed ids are small enough.
SAMPLE = 20_000
FEATURE_BITS = 14
GRAIN = 8
BINS = 1024
LEAST_FILL = 0.1


def _features(text: str | None, extra: list[str | None]) -> np.ndarray:
    words = [text or ""] + [f"{k}q{x}" for k, x in enumerate(extra) if x]
    return np.unique(shingles.word_hashes(words)[0] >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


class NaiveBayes:
    """Bernoulli-like naive Bayes over hashed words; ``fit`` on a bounded sample."""

    def __init__(self, labels: list[str]):
        self.labels = labels
        self.count = np.full((len(labels), 1 << FEATURE_BITS), 0.1)
        self.docs = np.ones(len(labels))

    def fit(self, rows: list[tuple[str, np.ndarray]]) -> NaiveBayes:
        for label, f in rows:
            k = self.labels.index(label)
            self.count[k, f] += 1
            self.docs[k] += 1
        self.logs = np.log(self.count / (self.docs[:, None] + 0.2))
        return self

    def posterior(self, f: np.ndarray) -> np.ndarray:
        s = np.log(self.docs / self.docs.sum()) + self.logs[:, f].sum(1) / max(1.0, len(f) ** 0.5)
        p = np.exp(s - s.max())
        return p / p.sum()


def _in_grains(p: np.ndarray) -> list[int]:
    """A posterior in ``1 / GRAIN`` steps that add up to one: largest remainders first."""
    x = p * GRAIN
    low = np.floor(x).astype(int)
    for k in np.argsort(low - x, kind="stable")[: GRAIN - low.sum()]:
        low[k] += 1
    return low.tolist()


def memberships(docs: DataFrame, targets: list[str], id_col: str, text_col: str, source_col: str, extra: list[str]) -> DataFrame:
    """``(id, source, grains, n_tokens)``: membership of each usable document in the sources ``targets``."""
    listed = F.col(source_col).isin(targets)
    n = docs.where(listed).count()
    share = F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < int(1_000_000 * min(1.0, SAMPLE / max(n, 1))) + 1
    sample = docs.where(listed & share).select(source_col, text_col, *extra)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(k).to_pylist() for k in range(b.num_columns)]
            feats = [_features(t, list(x)).astype(np.int32).tobytes() for t, *x in zip(*cols[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(feats, pa.binary())], names=["label", "f"])

    fitted = NaiveBayes(targets)
    if not docs.where(F.col(source_col).isNull()).isEmpty():
        fitted.fit([(r.label, np.frombuffer(r.f, np.int32)) for r in sample.mapInArrow(reduce, "label string, f binary").toLocalIterator()])
    model = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {s: k for k, s in enumerate(targets)}
        for b in batches:
            sources, texts = b.column(1).to_pylist(), b.column(2).to_pylist()
            more = [b.column(k).to_pylist() for k in range(3, b.num_columns)]
            n = encoding.encode_texts(texts, encoding.TOKENIZERS, "byte_bpe_50k")[1]
            grains = []
            for k, (s, t) in enumerate(zip(sources, texts)):
                if s is None:
                    grains.append(_in_grains(model.value.posterior(_features(t, [m[k] for m in more]))))
                else:
                    own = [0] * len(targets)
                    own[at[s]] = GRAIN
                    grains.append(own)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(grains, pa.list_(pa.int32())), pa.array(n)], names=["id", "source", "grains", "n_tokens"])

    usable = docs.where(listed | F.col(source_col).isNull()).select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"), *extra)
    return spread(usable).mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, source string, grains array<int>, n_tokens long")


def fit_rates(grains: np.ndarray, tokens: np.ndarray, shares: np.ndarray, caps: np.ndarray, least_fill: float = LEAST_FILL) -> tuple[np.ndarray, np.ndarray]:
    """Rates of the memberships ``grains`` (rows) with ``tokens`` each, and the tokens wanted of each source."""
    p = grains / GRAIN
    top = np.where(p > 0, caps, np.inf).min(1)  # no document may exceed the cap of any source it counts for
    room = (p * (tokens * top)[:, None]).sum(0)
    have = room > 0
    if not have.any():
        return np.zeros(len(tokens)), np.zeros(len(shares))
    total = max(min(room[s] / shares[s] for s in np.flatnonzero(have & (shares > 0))), least_fill * tokens.sum())
    want = np.minimum(np.where(have, shares * total, 0), room)
    weight = (p * tokens[:, None]).sum(0)
    rate = np.minimum(top, 1.0)
    scale = 1 / np.maximum(weight, 1)  # gradient of the squared relative gaps, with unit curvature in every source
    for _ in range(2000):
        gap = (p * (tokens * rate)[:, None]).sum(0) - want
        new = np.clip(rate - p @ (gap * scale), 0, top)
        if np.abs(new - rate).max() < 1e-9:
            break
        rate = new
    return rate, want


def _fill(row: np.ndarray, part: float) -> np.ndarray:
    """Bins whose tokens add up to ``part`` as nearly as taking each that still fits, in order, and one more can do."""
    taken, total = np.zeros(len(row), bool), 0.0
    for k, x in enumerate(row):
        if x and total + x <= part + 1e-6:
            taken[k] = True
            total += x
    rest = np.where(taken | (row == 0), np.inf, np.abs(total + row - part))
    if rest.min() < part - total:
        taken[int(rest.argmin())] = True
    return taken


def _repeated(held: DataFrame, rules: list[tuple[list[int], int, list[bool]]]) -> DataFrame:
    """``held`` with the repeats that the rules ``(grains, whole, bins once more)`` give; their number is bounded."""
    rule = held.sparkSession.createDataFrame(rules, "grains array<int>, whole int, more array<boolean>")
    return held.join(F.broadcast(rule), "grains").withColumn("repeats", F.col("whole") + F.get("more", F.col("bin")).cast("int"))


_REPORT = "source string, target_share double, max_repeats int, tokens_wanted double, n_documents long, n_used long, tokens_there long, tokens double, most_repeats int, actual_share double"


def mix(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", extra: tuple[str, ...] = ("lang", "kind"), least_fill: float = LEAST_FILL) -> tuple[DataFrame, DataFrame]:
    """``used(id, source, predicted, n_tokens, repeats)`` and ``report`` with the shares reached.

    ``targets`` is the small table ``source, target_share, max_repeats``; of repeated rows the largest counts, null
    sources and shares are ignored and shares are scaled to add up to one.  Null and empty texts have no tokens and
    are never used; documents with a null source are used by their predicted membership and marked ``predicted``;
    empty tables give no used documents and, for sources without documents, a share of zero.
    """
    spark = docs.sparkSession
    goal = targets.where("source is not null and target_share > 0").groupBy("source").agg(F.max("target_share").alias("w"), F.max("max_repeats").alias("cap")).orderBy("source").collect()
    names = [r.source for r in goal]
    shares = np.array([r.w for r in goal], float)
    shares = shares / shares.sum() if len(shares) else shares
    caps = np.array([1 if r.cap is None else max(r.cap, 0) for r in goal], float)
    if not names:
        key = docs.schema[id_col].dataType.simpleString()
        nothing = spark.createDataFrame([], f"id {key}, source string, predicted boolean, n_tokens long, repeats int")
        return nothing, spark.createDataFrame([], _REPORT)
    held = write_table(memberships(docs, names, id_col, text_col, source_col, list(extra)).where("n_tokens > 0").withColumn("bin", F.pmod(F.xxhash64("id"), F.lit(BINS)).cast("int")), "members")
    # at most as many memberships as there are ways to give GRAIN grains to the sources
    sums = held.groupBy("grains").agg(F.sum("n_tokens").alias("t")).orderBy("grains").collect()
    grains = np.array([r.grains for r in sums]).reshape(len(sums), len(names))
    rate, want = fit_rates(grains, np.array([r.t for r in sums], float), shares, caps, least_fill) if sums else (np.zeros(0), np.zeros(len(names)))
    rules = [(g, int(np.floor(x)), (np.arange(BINS) < round((x - np.floor(x)) * BINS)).tolist()) for g, x in zip(grains.tolist(), rate.tolist()) if max(g) < GRAIN]
    # what the documents of several sources really give to each; the others fill up the rest
    mixed = _repeated(held.where("source is null and array_max(grains) < " + str(GRAIN)), rules)
    given = {r.k: r.t for r in mixed.select(F.posexplode("grains").alias("k", "g"), (F.col("n_tokens") * F.col("repeats")).alias("t")).groupBy("k").agg((F.sum(F.col("g") * F.col("t")) / GRAIN).alias("t")).collect()}
    # a bounded table: the tokens of each bin of each source
    sure = held.where("array_max(grains) = " + str(GRAIN)).select((F.array_position("grains", GRAIN) - 1).cast("int").alias("k"), "bin", "n_tokens")
    table = np.zeros((len(names), BINS))
    for r in sure.groupBy("k", "bin").agg(F.sum("n_tokens").alias("t")).collect():
        table[r.k, r.bin] = r.t
    single = {g.index(GRAIN): x for g, x in zip(grains.tolist(), rate.tolist()) if max(g) == GRAIN}
    fitted = {k: sum(g[k] * r.t * x for g, r, x in zip(grains.tolist(), sums, rate.tolist()) if max(g) < GRAIN) / GRAIN for k in range(len(names))}
    for k, row in enumerate(table):
        if (all_ := row.sum()) > 0:
            # the fitted rate of the source, and what whole repeats of documents of several sources gave too much or little
            part = min(max(single.get(k, 0.0) * all_ + fitted[k] - given.get(k, 0.0), 0.0), caps[k] * all_)
            whole = int(part // all_)
            rules.append(([GRAIN * (j == k) for j in range(len(names))], whole, _fill(row, part - whole * all_).tolist()))
    used = _repeated(held, rules)
    named = F.array(*[F.lit(n) for n in names])
    best = F.element_at(named, F.array_position("grains", F.array_max("grains")).cast("int"))
    used = used.select("id", F.coalesce("source", best).alias("source"), F.col("source").isNull().alias("predicted"), "grains", "n_tokens", "repeats")
    each = used.select(F.posexplode("grains").alias("k", "g"), "n_tokens", "repeats").where("g > 0").groupBy("k").agg(F.count("*").alias("n_documents"), F.count_if(F.col("repeats") > 0).alias("n_used"), F.sum("n_tokens").alias("tokens_there"), F.sum(F.col("g") * F.col("n_tokens") * F.col("repeats") / GRAIN).alias("tokens"), F.max("repeats").alias("most_repeats"))
    plan = spark.createDataFrame([(k, n, float(s), int(c), float(w)) for k, (n, s, c, w) in enumerate(zip(names, shares, caps, want))], "k int, source string, target_share double, max_repeats int, tokens_wanted double")
    report = plan.join(each, "k", "left").na.fill(0, ["n_documents", "n_used", "tokens_there", "tokens", "most_repeats"])
    total = report.agg(F.sum("tokens").alias("total"))
    report = report.crossJoin(F.broadcast(total)).withColumn("actual_share", F.when(F.col("total") > 0, F.col("tokens") / F.col("total")).otherwise(F.lit(0.0)))  # one row on the right
    return used.where("repeats > 0").drop("grains"), report.drop("k", "total")
