"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are lower-cased runs of letters and digits. Seeds
of ``SEED`` neighbouring tokens that a document shares with an item are found
by Karp-Rabin hashes of token numbers (equal hashes are verified token by
token). For each (document, item) pair that shares a seed, tiling repeats: run
Karp-Rabin over the tokens not yet marked, join neighbouring seeds to maximal
matches, mark the longest that do not overlap, until none of ``SEED`` tokens
is left. The share of the item's tokens under tiles is its coverage, whatever
order the tiles stand in; a pair at or over ``COVERAGE`` is contaminated.

The benchmark is a stated query set: it is read in blocks of at most
``BLOCK_BYTES`` of text, each broadcast for one pass over the documents, so
its size never has to fit a worker. Items of fewer tokens than SEED must occur
whole; items without tokens (null, empty) never match, nor do empty texts.
Repeated items or documents give a row each. A document's own length does not matter.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import common

SEED, COVERAGE = 5, 0.8
BLOCK_BYTES = 8 << 20
#: Pairs of seeds that a document and an item may have before longer seeds go first.
SEEDS = 1 << 20
TOKEN = re.compile(r"[^\W_]+")
BASE = np.uint64(0x100000001B3)


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin values of all runs of n token numbers."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    x = common.mix64(ids.astype(np.uint64) + np.uint64(1))
    h = np.zeros(len(ids) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = h * BASE + x[k : k + len(h)]
    return h


def tile(doc: np.ndarray, item: np.ndarray, seed: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in document, place in item, length) of each tile."""
    least = min(seed, len(item))
    doc_free, item_free, found = np.ones(len(doc), bool), np.ones(len(item), bool), []
    if not least or len(doc) < least:
        return found
    # Where few tokens repeat very often, long matches go first: they leave little to seed the short ones.
    n = least
    while n < min(len(item), len(doc)) and _seeds(doc, item, doc_free, item_free, n)[1].sum() > SEEDS:
        n = min(2 * n, len(item), len(doc))
    while True:
        found += _tiles(doc, item, doc_free, item_free, n)
        if n == least:
            return found
        n = max(least, n // 2)


def _seeds(doc, item, doc_free, item_free, n) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first place among ``order``, how many places, by place in the document; places in the item by hash; places in the
    document) of runs of n free tokens with equal hashes."""
    taken = (np.concatenate([[0], np.cumsum(~free)]) for free in (doc_free, item_free))
    j, i = (np.flatnonzero(t[n:] == t[:-n]) for t in taken)
    doc_hash, item_hash = rolling(doc, n)[j], rolling(item, n)[i]
    order = np.argsort(item_hash, kind="stable")
    low = np.searchsorted(item_hash[order], doc_hash, "left")
    return low, np.searchsorted(item_hash[order], doc_hash, "right") - low, i[order], j


def _tiles(doc, item, doc_free, item_free, n) -> list[tuple[int, int, int]]:
    """Tiles of n or more free tokens, the longest first; marks them."""
    low, many, order, place = _seeds(doc, item, doc_free, item_free, n)
    j = np.repeat(place, many)
    if not len(j):
        return []
    i = order[np.repeat(low - np.cumsum(many) + many, many) + np.arange(len(j))]
    for k in range(n):  # equal hashes, token by token
        same = doc[j + k] == item[i + k]
        i, j = i[same], j[same]
    found = []
    while len(i):
        order = np.lexsort((j, j - i))
        i, j = i[order], j[order]
        breaks = np.flatnonzero((np.diff(j) != 1) | (np.diff(j - i) != 0)) + 1
        starts, ends = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(i)]])
        size = ends - starts + n - 1
        longest = size.max()
        pick = starts[size == longest]
        for a, b in sorted(zip(j[pick].tolist(), i[pick].tolist(), strict=True)):
            if doc_free[a : a + longest].all() and item_free[b : b + longest].all():
                doc_free[a : a + longest] = False
                item_free[b : b + longest] = False
                found.append((a, b, int(longest)))
        free_doc = np.concatenate([[0], np.cumsum(~doc_free)])
        free_item = np.concatenate([[0], np.cumsum(~item_free)])
        keep = (free_doc[j + n] == free_doc[j]) & (free_item[i + n] == free_item[i])
        i, j = i[keep], j[keep]
    return found


def build(items: list[tuple[int, str | None]]) -> dict:
    """Vocabulary, token numbers of the items, and their seeds by hash."""
    vocabulary: dict[str, int] = {}
    numbers = [np.array([vocabulary.setdefault(t, len(vocabulary)) for t in tokens(text)], np.int64) for _, text in items]
    seeds = {}
    for n in {min(SEED, len(x)) for x in numbers if len(x)}:
        own = [k for k, x in enumerate(numbers) if min(SEED, len(x)) == n]
        hashes = [rolling(numbers[k], n) for k in own]
        owner = np.repeat(own, [len(h) for h in hashes])
        pairs = np.unique(np.stack([np.concatenate(hashes), owner.astype(np.uint64)], 1), axis=0)
        seeds[n] = (pairs[:, 0].copy(), pairs[:, 1].astype(np.int64))
    return {"vocabulary": vocabulary, "ids": [k for k, _ in items], "numbers": numbers, "seeds": seeds}


def candidates(index: dict, doc: np.ndarray) -> list[int]:
    """Items that share a seed with the document."""
    found: set[int] = set()
    for n, (hashes, owner) in index["seeds"].items():
        if len(doc) < n:
            continue
        unknown = np.concatenate([[0], np.cumsum(doc < 0)])
        h = np.unique(rolling(doc, n)[unknown[n:] == unknown[:-n]])
        low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        for a, b in zip(low[low < high], high[low < high], strict=True):
            found.update(owner[a:b].tolist())
    return sorted(found)


SCHEMA = "doc_id long, item_id long, item_tokens long, covered long, n_tiles long, coverage double"


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every (document, item) pair that shares a seed, with its coverage."""
    spark = common.prepare(docs.sparkSession)
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def one(shared) -> DataFrame:
        def start():
            index = shared.value

            def step(batch):
                rows = [(key, *row) for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for row in covered(index, text)]
                return list(map(list, zip(*rows, strict=True))) if rows else None

            return step

        return common.mapped(mine, SCHEMA, start)

    return reduce(DataFrame.unionByName, map(one, blocks(spark, benchmark)))


def blocks(spark: SparkSession, benchmark: DataFrame):
    """The benchmark's blocks, built and broadcast one by one."""
    n = int((benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES) + 1
    for k in range(n):
        part = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield spark.sparkContext.broadcast(build([(r[0], r[1]) for r in part.orderBy("item_id", "text").collect()]))


def covered(index: dict, text: str | None):
    """(item_id, item_tokens, covered, n_tiles, coverage) for each item that shares a seed with a text."""
    known = index["vocabulary"]
    doc = np.array([known.get(t, -1) for t in tokens(text)], np.int64)
    for k in candidates(index, doc):
        item = index["numbers"][k]
        tiles = tile(doc, item)
        if tiles:
            n = sum(n for _, _, n in tiles)
            yield index["ids"][k], len(item), n, len(tiles), n / len(item)


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    return overlaps(docs, benchmark).where(F.col("coverage") >= coverage)


def decontaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without contaminated documents; columns unchanged. Each row is judged by its own text."""
    spark = common.prepare(docs.sparkSession)
    for shared in blocks(spark, benchmark):

        def start(shared=shared):
            index = shared.value
            return lambda texts: [not any(row[-1] >= coverage for row in covered(index, t)) for t in texts]

        docs = common.filtered(docs, start)
    return docs


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(docs, benchmark)
