"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained in numpy.

A word's vector is the mean of the embeddings of its hashed character n-grams
(3 to 5 bytes of ``<word>``, lower-cased) - so a misspelling never seen shares most of its
vector with the word. A window of ``WINDOW`` neighbouring words is the mean of its words; a
linear softmax over the two classes is trained jointly with the embeddings, by
full-batch gradient steps with momentum. Labels are given to documents, so training takes passes:
first every window bears its document's label; then, in toxic documents, only the windows that the last
model found most toxic count. A document's score is that of its most toxic window,
moved so that 0.5 is the best border on the training documents.

The fit reads at most ``PER_CLASS`` documents of each label, those of least hashed id;
scoring covers every word of every text. Null and empty texts have one empty
window. Without training rows of both labels every score is 0. Rows of
``labels`` with nulls are ignored; of repeated ids the greater label counts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import common

PER_CLASS = 1200
WINDOW, WIDTH, BUCKETS, ROUNDS, PASSES, RATE = 3, 8, 1 << 16, 40, 3, 3.0
HOLD_MOD, HOLD_AT = 5, 0
CACHE, SOME = 1 << 18, 1 << 14


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket ids of all n-grams in word order, how many for each word), some words at a time."""
    ids, size = zip(*(_subwords(words[at : at + SOME]) for at in range(0, len(words), SOME)), strict=True)
    return np.concatenate(ids), np.concatenate(size)


def _subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    marked = [b"<" + w + b">" for w in words]
    raw = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    size = np.array([len(w) for w in marked], np.int64)
    owner = np.repeat(np.arange(len(words)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(raw))  # bytes to the word's end
    ids, owners = [], []
    h = np.zeros(len(raw), np.uint64)
    for n in range(1, 6):
        if n > len(raw):
            break
        with np.errstate(over="ignore"):
            h = h[: len(raw) - n + 1] * np.uint64(1099511628211) + raw[n - 1 :] + np.uint64(1)
        if n >= 3:
            ok = left[: len(h)] >= n
            ids.append((common.mix64(h[ok] + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.uint16 if BUCKETS <= 1 << 16 else np.int64))
            owners.append(owner[: len(h)][ok])
    owners, ids = np.concatenate(owners), np.concatenate(ids)
    order = np.argsort(owners, kind="stable")
    return ids[order], np.bincount(owners, minlength=len(words))


def word_means(table: np.ndarray, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    return np.add.reduceat(table[ids], starts, axis=0) / size.reshape(-1, *[1] * (table.ndim - 1))


def windows(n: int) -> np.ndarray:
    """Starts of the windows over n words; the last one ends with the last word."""
    return np.arange(max(0, n - WINDOW) + 1)


def train(texts: list[str], labels: list[int]) -> dict | None:
    """Buckets' scores, bias and border; None without both labels."""
    if len(set(labels)) < 2:
        return None
    names: dict[bytes, int] = {}
    words = [np.fromiter((names.setdefault(w, len(names)) for w in common.lower_words(t.encode("utf-8", "surrogatepass"))), np.int64) for t in texts]
    if not names:
        return None
    ids, size = subwords(list(names))
    count = np.array([len(x) for x in words])
    word = np.concatenate(words)
    # Windows by their first and past their last word; no two have the same first or last one.
    begin = np.cumsum(count) - count
    many = np.where(count > 0, np.maximum(count - WINDOW + 1, 1), 0)
    doc = np.repeat(np.arange(len(texts)), many)
    first = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
    per = np.minimum(count, WINDOW)[doc]
    y = np.array(labels)[doc]
    share = 1.0 / many[doc]  # each document weighs the same
    del words, names

    def means(scores: np.ndarray) -> np.ndarray:
        """Mean score of each window's words."""
        total = np.concatenate([[0.0], np.cumsum(scores[word])])
        return (total[first + per] - total[first]) / per

    def to_words(x: np.ndarray) -> np.ndarray:
        """Each window's value, shared among its words, added up by word."""
        edge = np.zeros(len(word) + 1)
        edge[first] += x / per
        edge[first + per] -= x / per
        return np.bincount(word, np.cumsum(edge)[:-1], len(size))

    def fit(weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        rng = np.random.default_rng(9)
        w = weight / np.where(y == 1, weight[y == 1].sum(), weight[y == 0].sum())
        seen = np.bincount(ids, np.repeat(to_words(w) / size, size), BUCKETS)
        # Steps in units of a bucket's chance fluctuation: neither common nor rare n-grams run ahead.
        scale = 1 / np.sqrt(seen + 1 / len(texts) / 50)
        table, linear, bias = rng.normal(0, 0.02, (BUCKETS, WIDTH)), np.full(WIDTH, WIDTH**-0.5), 0.0
        pace = np.zeros(BUCKETS)
        for step in range(ROUNDS):
            scores = word_means(table @ linear, ids, size)
            logit = means(scores) + bias
            slope = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y) * w
            to_word = to_words(slope) / size
            to_bucket = np.bincount(ids, np.repeat(to_word, size), BUCKETS)
            pace = 0.7 * pace + 0.3 * to_bucket * scale
            rate = RATE * (1 - step / ROUNDS)
            up = table.T @ to_bucket
            table -= rate * pace[:, None] * linear[None] / (np.abs(pace).max() + 1e-12)
            linear -= 0.1 * rate * up / (np.abs(up).max() + 1e-12)
            bias -= 2.0 * slope.sum()
        return table @ linear, word_means(table @ linear, ids, size), bias

    def tops(scores: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
        value = means(scores) + bias
        best = np.full(len(texts), bias)
        np.maximum.at(best, doc, value)
        return value, best

    weight = share
    for _ in range(PASSES):
        table, scores, bias = fit(weight)
        value, best = tops(scores, bias)
        weight = np.where(y == 0, share, (value >= best[doc] - 1e-9).astype(float))
    truth = np.array(labels)
    cuts = np.unique(best)
    middles = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
    place = np.searchsorted(np.sort(best[truth == 1]), middles), np.searchsorted(np.sort(best[truth == 0]), middles)
    right = (1 - place[0] / (truth == 1).sum()) + place[1] / (truth == 0).sum()
    good = middles[right >= right.max() - 1e-12]
    border = float(good[len(good) // 2])
    return {"table": table.astype(np.float32), "bias": bias, "border": border}


class Scorer:
    """Scores texts with a trained model; remembers the scores of words."""

    def __init__(self, model: dict | None):
        self.model, self.known = model, {}

    def scores(self, texts: list[bytes]) -> list[float]:
        if self.model is None:
            return [0.0] * len(texts)
        known, bias = self.known, self.model["bias"]
        if len(known) > CACHE:
            known.clear()
        split = [common.lower_words(t) for t in texts]
        new = list({w for s in split for w in s if w not in known})
        if new:
            ids, size = subwords(new)
            known.update(zip(new, word_means(self.model["table"].astype(np.float64), ids, size).tolist(), strict=True))
        out = []
        for s in split:
            top = bias
            if s:
                v = np.concatenate([[0.0], np.cumsum([known[w] for w in s])])
                at, n = windows(len(s)), min(WINDOW, len(s))
                top = float((v[at + n] - v[at]).max()) / n + bias
            out.append(1 / (1 + float(np.exp(min(60.0, max(-60.0, -(top - self.model["border"])))))))
        return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict | None:
    """Trains on at most ``per_class`` labelled documents of each class."""
    spark = docs.sparkSession
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").alias("toxic"))
    ordered = lambda k: known.where(F.col("toxic") == k).orderBy(F.xxhash64("id"), "id").limit(per_class).collect()
    chosen = [(r["id"], int(r["toxic"])) for k in (0, 1) for r in ordered(k)]
    some = spark.createDataFrame(chosen, "id long, toxic int")
    rows = docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("id")).select("id", "text", "toxic").collect()
    rows = sorted(rows, key=lambda r: (r["id"], r["text"] or ""))
    return train([r["text"] or "" for r in rows], [r["toxic"] for r in rows])


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, score) for every row."""
    common.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats

    def start():
        scorer = Scorer(shared.value)

        def step(batch):
            return [batch.column(0), scorer.scores(batch.column(1).to_pylist())]

        return step

    return common.mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.body(F.col("text")).alias("b")), "doc_id long, score double", start)


def held(doc_id) -> object:
    return common.split_of(doc_id, HOLD_MOD) == HOLD_AT


def scored(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, fit(docs, labels.where(~held(F.col("doc_id")))))


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without those that the model calls toxic; columns unchanged. Each row is judged by its own text."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held(F.col("doc_id"))))
    shared = common.prepare(spark).sparkContext.broadcast(model)  # BUCKETS floats

    def start():
        scorer = Scorer(shared.value)
        return lambda texts: [s < 0.5 for s in scorer.scores([(t or "").encode("utf-8", "surrogatepass") for t in texts])]

    return common.filtered(docs, start)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scored(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    return out.select("doc_id", held(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
