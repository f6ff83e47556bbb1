"""Language identification with hyperdimensional profiles.

Each letter class has a random +-1 vector. A letter trigram abc is bound as
rotate(a, 2) * rotate(b, 1) * c; a text is the bundle (sum) of its trigrams; a
language's prototype is the bundle of its training texts, each scaled to length
one. Texts are compared with prototypes by cosine after the mean of the prototypes is taken off.

Letters: lower-cased; a-z have classes of their own, other letters hash into
the rest of ``CLASSES``; everything else is one gap, runs of gaps count once.
Null text, or text without a letter: ``und`` with score 0. With no labelled
training rows every document is ``und``. Ties go to the first name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import common

CLASSES, WIDTH = 48, 512
#: Has no factor in common with the number of classes beyond a-z, so neighbouring letters take all of them.
SPREAD = 11
HOLD_MOD, HOLD_AT = 4, 2


def letter_table() -> np.ndarray:
    """Letter class of each code point of the basic plane."""
    table = np.zeros(1 << 16, np.uint8)
    for cp in range(1 << 16):
        if not 0xD800 <= cp < 0xE000 and chr(cp).isalpha():
            table[cp] = cp - 96 if 97 <= cp <= 122 else 27 + cp * SPREAD % (CLASSES - 27)
    return table


_CACHE: dict = {}


def table() -> np.ndarray:
    if "letters" not in _CACHE:
        _CACHE["letters"] = letter_table()
    return _CACHE["letters"]


def gram_vectors() -> np.ndarray:
    """(CLASSES**3, WIDTH) int8: the bound vector of every trigram."""
    if "grams" not in _CACHE:
        base = np.random.default_rng(20).choice(np.array([-1, 1], np.int8), (CLASSES, WIDTH))
        a, b = np.roll(base, 2, 1), np.roll(base, 1, 1)
        _CACHE["grams"] = (a[:, None, None] * b[None, :, None] * base[None, None]).reshape(-1, WIDTH)
    return _CACHE["grams"]


def bundle(text: str | None) -> np.ndarray | None:
    """The text's vector; None if it has no letter."""
    if not text:
        return None
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = table()[np.minimum(cp, 0xFFFF)]
    if len(cp) and cp.max() > 0xFFFF:
        for i in np.flatnonzero(cp > 0xFFFF):
            c[i] = 27 + int(cp[i]) * SPREAD % (CLASSES - 27) if chr(cp[i]).isalpha() else 0
    if not c.any():
        return None
    c = np.concatenate([[0], c, [0]])
    c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])].astype(np.int32)
    if len(c) < 3:
        return None
    counts = np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:])
    used = np.flatnonzero(counts)
    grams = gram_vectors()
    total = np.zeros(WIDTH, np.float32)
    for at in range(0, len(used), 4096):  # bounded whatever the text's length
        part = used[at : at + 4096]
        total += counts[part].astype(np.float32) @ grams[part].astype(np.float32)
    return total


def fit(train: DataFrame) -> tuple[list[str], np.ndarray]:
    """Prototypes from (text, lang): every training row counts, added up in the tasks.

    What reaches the driver is WIDTH numbers for each language.
    """
    common.prepare(train.sparkSession)

    def run(batches):
        import pyarrow as pa

        sums: dict = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = bundle(text)
                if x is not None and (size := np.linalg.norm(x)):
                    sums[lang] = sums.get(lang, 0) + (x / size).astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([list(x) for x in sums.values()], pa.list_(pa.float64()))], names=["lang", "v"])

    parts = train.select("text", "lang").where("lang is not null and text is not null").mapInArrow(run, "lang string, v array<double>")
    rows = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x")).collect()
    names = sorted({r["lang"] for r in rows})
    vectors = np.zeros((len(names), WIDTH))
    place = {x: k for k, x in enumerate(names)}
    for r in rows:
        vectors[place[r["lang"]], r["i"]] = r["x"]
    return names, np.round(vectors, 6)


def predict(docs: DataFrame, names: list[str], vectors: np.ndarray) -> DataFrame:
    """(doc_id, lang_pred, score); score is (1 + cosine) / 2."""
    common.prepare(docs.sparkSession)
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12) if len(names) else vectors
    middle = unit.mean(0) if len(names) > 1 else np.zeros(WIDTH)
    centred = unit - middle
    centred = centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)

    def start():
        def step(batch):
            langs, scores = [], []
            for text in batch.column(1).to_pylist():
                x = bundle(text) if names else None
                if x is None:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                x = x / max(np.linalg.norm(x), 1e-12) - middle
                cosines = centred @ x / max(np.linalg.norm(x), 1e-12)
                best = int(np.argmax(cosines))
                langs.append(names[best])
                scores.append(float(min(1.0, max(0.0, (1 + cosines[best]) / 2))))
            return [*(batch.column(i) for i in range(batch.num_columns) if i != 1), langs, scores]

        return step

    return common.mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id long, lang_pred string, score double", start)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = common.split_of(F.col("doc_id"), HOLD_MOD)
    names, vectors = fit(docs.where(held != HOLD_AT))
    out = predict(docs, names, vectors)
    return out.select("doc_id", (held == HOLD_AT).alias("held_out"), "lang_pred", "score")
