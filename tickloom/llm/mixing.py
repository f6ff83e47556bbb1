"""Soft-membership mixing towards target weights.

Domains are the values of a column of the labelled table (``quality`` by
default). A naive Bayes classifier over hashed words and word endings, with one
temperature set on the half of the sample it was not fitted on, gives each document a posterior over
domains. With t tokens and posterior p, a document at rate r adds r * t * p to the
domains' expected token totals. Projected gradient descent finds rates of at least
``floor`` (0: nonnegative) that minimise the squared distance from the totals to the targets:

    r <- max(floor, r - A W (A' r - T)),   A = t * p,   W = (F' F)^-1

W is one small matrix (domains x domains) of the rows F whose rate is above the floor; it only rescales the distance. A
step that does not come nearer is taken back and taken with W of all rows instead. All
that a round sends to the driver is a total for each domain and pair of domains, and rates are recomputed from
the rounds' history of those totals instead of being stored, so a lost executor
costs nothing but its tasks. Rounds end when the totals are met or come no nearer; totals that stay off the target by more than
``WARN`` of its sum are reported by a warning.

A document is then written floor(r + u) times, u its own hashed uniform number.
Fitted on at most ``PER_DOMAIN`` labelled documents of each domain (least hashed id);
everything else covers all documents. Each row has its own rate. Null and empty texts have zero tokens and the prior as their
posterior, hence rate max(1, floor). Without labels there is one domain, ``all``.
Target weights default to the domains' present shares to the power ``TEMPER``, normalised.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tickloom.llm import common

PER_DOMAIN, FEATURES, TEMPER = 1500, 1 << 15, 0.7
#: Relative distance from the targets that counts as met, gain of a round that counts as none, miss that is reported.
CLOSE, STILL, WARN = 1e-7, 1e-2, 1e-3
KNOWN = 1 << 17


def features(raw: bytes, known: dict) -> tuple[np.ndarray, int]:
    """Hashed words and three-byte word endings, as two neighbouring feature numbers for each word."""
    words = common.lower_words(raw)
    if len(known) > KNOWN:
        known.clear()
    for w in set(words).difference(known):
        known[w] = (xxhash.xxh64_intdigest(w) % FEATURES) << 32 | xxhash.xxh64_intdigest(w[-3:], 1) % FEATURES + FEATURES
    both = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    return np.stack([both >> 32, both & 0xFFFFFFFF], 1).ravel(), len(words)


class Classifier:
    def __init__(self, texts: list[bytes], labels: list[str]):
        self.names = sorted(set(labels)) or ["all"]
        self.known: dict = {}
        rows = [features(t, self.known)[0] for t in texts]
        y = np.array([self.names.index(x) for x in labels], np.int64)
        odd = np.arange(len(y)) % 2 == 1
        self.heat = 1.0
        if len(self.names) > 1 and len(y) > 3:
            self._count([r for r, o in zip(rows, odd, strict=True) if not o], y[~odd])
            held = [(self._mean(r), k) for r, k, o in zip(rows, y, odd, strict=True) if o]
            best = -np.inf
            for heat in 2.0 ** np.arange(0, 9):
                self.heat = heat
                fit = sum(np.log(self._soft(m)[k] + 1e-9) for m, k in held)
                if fit > best:
                    best, keep = fit, heat
            self.heat = float(keep)
        self._count(rows, y)
        del self.known

    def _count(self, rows: list[np.ndarray], y: np.ndarray) -> None:
        counts = np.stack([np.bincount(np.concatenate([np.zeros(0, np.int64), *(r for r, k in zip(rows, y, strict=True) if k == c)]), minlength=2 * FEATURES) for c in range(len(self.names))]) + 0.5
        self.table = np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)
        self.prior = np.log((np.bincount(y, minlength=len(self.names)) + 1) / (len(y) + len(self.names)))

    def _mean(self, ids: np.ndarray) -> np.ndarray:
        return self.table[:, ids].mean(1, dtype=np.float64) if len(ids) else np.zeros(len(self.names))

    def _soft(self, mean: np.ndarray) -> np.ndarray:
        z = self.prior + self.heat * mean
        z = np.exp(z - z.max())
        return z / z.sum()

    def posterior(self, ids: np.ndarray) -> np.ndarray:
        return self._soft(self._mean(ids))


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", per_domain: int = PER_DOMAIN) -> Classifier:
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col(column).cast("string")).alias("domain"))
    domains = sorted(r[0] for r in known.select("domain").distinct().collect())
    chosen = [tuple(r) for d in domains for r in known.where(F.col("domain") == d).orderBy(F.xxhash64("id"), "id").limit(per_domain).collect()]
    some = spark.createDataFrame(chosen, "id long, domain string")
    rows = docs.select("doc_id", common.body(F.col("text")).alias("b")).join(F.broadcast(some), F.col("doc_id") == F.col("id")).select("id", "b", "domain").collect()
    rows = sorted(rows, key=lambda r: (xxhash.xxh64_intdigest(str(r["id"])), bytes(r["b"])))
    model = Classifier([bytes(r["b"]) for r in rows], [r["domain"] for r in rows])
    return model


def memberships(docs: DataFrame, model: Classifier, keep: list[str]) -> DataFrame:
    """(row, n_tokens, p): the columns ``keep`` as one, token count and domain posterior of every document."""
    common.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 * FEATURES floats a domain
    rows = docs.select(F.struct(*keep).alias("row"), common.body(F.col("text")).alias("b"))

    def start():
        use, known = shared.value, {}

        def step(batch):
            found = [features(x, known) for x in batch.column(1).to_pylist()]
            return [batch.column(0), [n for _, n in found], [use.posterior(ids).tolist() for ids, _ in found]]

        return step

    return common.mapped(rows, _schema(rows), start)


def _schema(rows: DataFrame, *more: StructField) -> StructType:
    return StructType([rows.schema["row"], StructField("n_tokens", LongType()), StructField("p", ArrayType(DoubleType())), *more])


def _batch(t: pa.Array, p: pa.Array) -> np.ndarray:
    """A = t * p, one row for each document."""
    t = t.to_numpy(zero_copy_only=False).astype(np.float64)
    return t[:, None] * p.flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)


def _replay(a: np.ndarray, pulls: list[np.ndarray], floor: float) -> np.ndarray:
    r = np.maximum(floor, np.ones(len(a)))
    for pull in pulls:
        r = np.maximum(floor, r - a @ pull)
    return r


def _sums(rows: DataFrame, width: int, each) -> np.ndarray:
    """Adds up ``each(A)`` (a vector of ``width``) over all batches: one row for each task."""

    def run(batches):
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += each(_batch(*batch.columns))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["v"])

    parts = rows.select("n_tokens", "p").mapInArrow(run, "v array<double>")
    found = parts.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(width)
    for r in found:
        out[r["i"]] = r["x"]
    return out


def rates(members: DataFrame, k: int, weights: np.ndarray | None = None, total: float | None = None, floor: float = 0.0, temper: float = TEMPER) -> tuple[DataFrame, dict]:
    """(row, n_tokens, p, rate) and the totals reached.

    ``total`` is the target token count; None keeps the present one, or, with a floor of 1 or more, leaves it
    open: the domains' totals then have to meet their weights' shares of the sum that is reached.
    """
    first = _sums(members, k + k * k, lambda a: np.concatenate([a.sum(0), (a.T @ a).ravel()]))
    now, gram = first[:k], first[k:].reshape(k, k)
    if weights is None:
        weights = (now / max(now.sum(), 1e-12)) ** temper
    weights = np.asarray(weights, float) / max(np.sum(weights), 1e-12)
    open_, total = total is None and floor >= 1, now.sum() if total is None else total
    target = np.zeros(k) if open_ else weights * total
    # With an open total each document counts by what it adds to a domain beyond the domain's share: a (I - 1 w').
    shift = np.eye(k) - (weights[None] if open_ else np.zeros((1, k)))
    gram = shift.T @ gram @ shift

    def inverse(gram: np.ndarray) -> np.ndarray:
        return np.linalg.pinv(gram, rcond=1e-9, hermitian=True)

    def totals(done: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        def each(a):
            a = a @ shift
            r = _replay(a, done, floor)
            free = a[r > floor]
            return np.concatenate([a.T @ r, (free.T @ free).ravel()])

        found = _sums(members, k + k * k, each)
        return found[:k], found[k:].reshape(k, k)

    slow = inverse(gram)
    miss = lambda x: float((x - target) @ slow @ (x - target))
    pulls: list[np.ndarray] = []
    reached, free = totals(pulls)
    while np.abs(reached - target).max(initial=0.0) > CLOSE * max(total, 1e-12):
        for w in (inverse(free), slow):
            tried = [*pulls, w @ (reached - target)]
            after, free_after = totals(tried)
            if miss(after) < miss(reached) * (1 - STILL):
                break
        else:
            break
        pulls, reached, free = tried, after, free_after
    off = float(np.abs(reached - target).max(initial=0.0)) / max(total, 1e-12)
    if off > WARN:
        warnings.warn(f"domain totals stay off their targets by {off:.2e} of the sum: rates cannot meet them", stacklevel=2)
    final = list(pulls)

    def start():
        def step(batch):
            return [*batch.columns, pa.array(_replay(_batch(*batch.columns[1:]) @ shift, final, floor)) if batch.num_rows else pa.array([], pa.float64())]

        return step

    out = common.mapped(members.select("row", "n_tokens", "p"), _schema(members, StructField("rate", DoubleType())), start)
    return out, {"before": now, "weights": weights, "rounds": len(pulls), "off": off}


def copies(rate, doc_id):
    """floor(rate + u), u uniform by the id's hash: on average ``rate`` rows."""
    u = F.pmod(F.xxhash64(F.coalesce(doc_id, F.lit(-1)), F.lit(11)), F.lit(1 << 24)) / F.lit(float(1 << 24))
    return F.floor(rate + u).cast("int")


def fitted(spark: SparkSession, docs: DataFrame, sf_dir: str, keep: list[str], **options) -> DataFrame:
    """(row, n_tokens, p, rate) of every row."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    members = common.stored(memberships(docs, model, keep), "members")
    return rates(members, len(model.names), **options)[0]


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str, **options) -> DataFrame:
    """``docs`` with each row repeated as its own rate says; columns unchanged. Rows with a null id stay as they are."""
    out = fitted(spark, docs, sf_dir, docs.columns, **options)
    n = F.when(F.col("row.doc_id").isNull(), 1).otherwise(copies(F.col("rate"), F.col("row.doc_id")))
    # A row is repeated by exploding a list of its copies' numbers; nothing is moved.
    return out.select("row", F.explode(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))).alias("k")).select("row.*")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fitted(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir, ["doc_id"]).select(F.col("row.doc_id").cast("long").alias("doc_id"), "n_tokens", "p", "rate")
    p = F.transform("p", lambda x: F.round(x, 6))
    return out.select("doc_id", "n_tokens", F.concat_ws(",", F.transform(p, lambda x: x.cast("string"))).alias("posterior"), F.round("rate", 6).alias("rate"), copies(F.col("rate"), F.col("doc_id")).alias("copies"))
