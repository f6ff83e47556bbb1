"""Secret scan: fixed patterns, plus character Markov models of random strings.

The patterns give the base spans. The method adds spans: every run of 16 or
more token characters that no base span touches is scored by two character
Markov chains (order two, backing off to shorter contexts), one trained on random strings,
one on ordinary identifiers; a run whose log-likelihood ratio for a character
is over ``THRESHOLD`` is a span of kind ``markov``.

Training samples are labelled by the corpus itself: values in base spans are
random, runs of letters outside them are ordinary. The fit uses the
``SAMPLE_DOCS`` documents of smallest hashed id and seeded random strings, a
stated bound; the scan itself covers every text. Empty and null texts have no
spans; an empty corpus leaves the seeded samples only.
"""

from __future__ import annotations

import hashlib
import re
import string

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import common

SAMPLE_DOCS = 2000
THRESHOLD = 0.5

#: Fixed patterns and least lengths of the contract, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "markov")

RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
LETTERS = re.compile(r"[A-Za-z]{4,}")
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
CODES = np.full(256, len(ALPHABET), np.int64)
CODES[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))
SIZE = len(ALPHABET) + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), ordered; code points, end exclusive."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def free_runs(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs of token characters that no span overlaps."""
    return [(m.start(), m.end()) for m in RUN.finditer(text) if not any(s < m.end() and m.start() < e for s, _, e in spans)]


def codes(s: str) -> np.ndarray:
    return CODES[np.frombuffer(s.encode("ascii"), np.uint8)]


def chain(samples: list[str]) -> np.ndarray:
    """log p(c | a, b), by counts of three neighbouring characters plus one."""
    counts = np.zeros(SIZE**3)
    for s in samples:
        c = np.concatenate([[SIZE - 1, SIZE - 1], codes(s)])
        np.add.at(counts, (c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], 1)
    counts = counts.reshape(SIZE, SIZE, SIZE)
    pair = counts.sum(0)  # backs off to one character before, then to none, where contexts are rare
    single = (pair.sum(0) + 0.5) / (pair.sum() + 0.5 * SIZE)
    p = (pair + 5 * single) / (pair.sum(-1, keepdims=True) + 5)
    return np.log((counts + 20 * p[None]) / (counts.sum(-1, keepdims=True) + 20)).ravel()


def ratio(model: np.ndarray, s: str) -> float:
    """Mean log-likelihood ratio of random against ordinary, for a character."""
    c = np.concatenate([[SIZE - 1, SIZE - 1], codes(s)])
    return float(model[(c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:]].mean())


def seeded(n: int = 3000, seed: int = 7) -> list[str]:
    """Random strings over hexadecimal, base-64 and upper-case alphabets."""
    rng = np.random.default_rng(seed)
    sets = (string.hexdigits[:16], ALPHABET[:62], ALPHABET[:64], string.ascii_uppercase + string.digits)
    return ["".join(rng.choice(list(sets[i % 4]), rng.integers(16, 48))) for i in range(n)]


def train(texts: list[str]) -> np.ndarray:
    """The log-ratio table of the two chains."""
    random, plain = seeded(), ["identifier", "configuration", "get_value", "max_length", "user_name"]
    for text in texts:
        spans = base_spans(text)
        random += [re.split(r"[:=\"'\x20]", text[s:e])[-1].replace(".", "") for s, k, e in spans if k != 0 or e - s > 24]
        hidden = [(s, e) for s, _, e in spans]
        plain += [m[0] for m in LETTERS.finditer(text) if not any(s < m.end() and m.start() < e for s, e in hidden)]
    return (chain([s for s in random if s]) - chain(plain)).astype(np.float32)


def spans_of(text: str, model: np.ndarray) -> tuple[list, list]:
    """(base spans, all spans)."""
    base = base_spans(text)
    extra = [(s, 3, e) for s, e in free_runs(text, base) if ratio(model, text[s:e]) > THRESHOLD]
    return base, sorted(base + extra)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def fit(docs: DataFrame, n: int = SAMPLE_DOCS) -> np.ndarray:
    key = F.xxhash64("doc_id")
    # The sample's greatest key first, of ids alone: sorting whole texts would send n of them from every task.
    last = docs.select(key.alias("h")).orderBy("h").limit(n).agg(F.max("h")).first()[0]
    rows = docs.select("doc_id", "text").where(key <= F.lit(last).cast("long")).orderBy(key, "doc_id", "text").limit(n).collect()
    return train([r["text"] or "" for r in rows])


def scan(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """(doc_id, base, spans): base and all spans of each text as lists of (start, kind, end)."""
    common.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 287k floats, whatever the corpus

    def start():
        table = shared.value

        def step(batch):
            found = [spans_of(t or "", table) for t in batch.column(1).to_pylist()]
            rows = [[[{"start": s, "kind": KINDS[k], "end": e} for s, k, e in x] for x in side] for side in zip(*found, strict=True)]
            return [batch.column(0), *rows] if found else None

        return step

    kind = "array<struct<start: int, kind: string, end: int>>"
    return common.mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), f"doc_id long, base {kind}, spans {kind}", start)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan(docs, fit(docs))
    label = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    text = lambda c: F.concat_ws(",", F.transform(c, label))
    return found.select("doc_id", *map(count, KINDS[:3]), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))
