"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs over all training texts are quantised to levels
1 + floor(log2 c); an n-gram of level q is put into the filter q times, as
(n-gram, 1) .. (n-gram, q). A level is read back by repeated probes: level 1, 2, ...
until one fails. A level stands for the mean count of its n-grams. With those,

    P(w | h) = k min(1, c(h w) / c(h)) + (1 - k) (c(w) + 1) / (N + V + 1)

smooths pairs with single words, and unseen words share the rest. The weight k belongs to the
level of h; expectation maximisation sets it on all training texts, each token's own
occurrence left out of the counts (deleted interpolation): a token counts by its three levels alone, so
the tokens of each such cell are added up in the tasks. The filter has ``BITS`` bits for each insertion and
holds every n-gram, whatever its count; it is split into segments by key, each built and probed by the one
task that counted its n-grams, so that no task holds it whole. Probes for absent n-grams
err with about 1 in 100.

Texts move once, to groups that ask about their different words and pairs, see exchange.py.
``base_score`` is exact: words' answers bring exact counts. Null and empty texts hold the end token
alone. Rows with a null id train the model. With an empty training part every word is unseen.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import common, exchange

HOLD_MOD, HOLD_AT = 7, 2
BITS, PROBES, MAX_BYTES = 10, 4, 32 << 20
LEVELS = 40


class Words:
    """Numbers the words that a worker has met; the table of their 64-bit keys."""

    def __init__(self):
        self.place: dict[bytes, int] = {b"": 0}  # the end token
        self.table = np.array([xxhash.xxh3_64_intdigest(b"", 3)], np.uint64)

    def numbers(self, raw: list[bytes]) -> list[np.ndarray]:
        """Word numbers of each text, the end token last."""
        place, fresh = self.place, []
        split = [common.lower_words(t) for t in raw]
        for words in split:
            words.append(b"")
            for w in words:
                if w not in place:
                    place[w] = len(place)
                    fresh.append(xxhash.xxh3_64_intdigest(w, 3))
        if fresh:
            self.table = np.concatenate([self.table, np.array(fresh, np.uint64)])
        return [np.fromiter(map(place.__getitem__, words), np.int64, len(words)) for words in split]


def pair_keys(keys: np.ndarray) -> np.ndarray:
    """Key of each word with the one before it; the end token comes before the first."""
    with np.errstate(over="ignore"):
        before = np.concatenate([[np.uint64(xxhash.xxh3_64_intdigest(b"", 3))], keys[:-1]])
        return common.mix64(before * np.uint64(0x9E3779B97F4A7C15) + keys)


def levels(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 c); 0 for 0."""
    return np.where(counts > 0, np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1, 0)


def total(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, np.flatnonzero(first))


#: Bits of a pair's key: among a thousand million pairs, 4 in a million share theirs.
PAIR_BITS = 48
ASK = "bucket int, g int, ngram int, keys binary, counts binary"
ANSWER = "g int, bucket int, ngram int, counts binary, levels binary, level int, ngrams long, mass long"


def packed(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, their first bytes first, then their second bytes: the upper ones
    are zero, which the shuffle's compression folds."""
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8")[:, 0]
    return np.cumsum(gaps, dtype=np.uint64)


def split_pairs(pairs: np.ndarray, n: int):
    """(bucket, places of its pairs) for ascending pairs; a pair's key in its bucket is pair // n."""
    bucket = (pairs % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n + 1))
    for k in range(n):
        if edges[k] < edges[k + 1]:
            yield k, order[edges[k] : edges[k + 1]]


def pairs_of(some: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """Keys of all texts' pairs, one after another."""
    return np.concatenate([pair_keys(table[x]) for x in some]) >> np.uint64(64 - PAIR_BITS)


def ask(docs: DataFrame) -> DataFrame:
    """Each group's different words and pairs with their counts in its training texts, to their buckets."""
    n = exchange.partitions(docs)

    def each(table):
        words = Words()
        raw, held = table.column("b").to_pylist(), np.array(table.column("held").to_pylist(), bool)
        some = words.numbers(raw)
        out = np.repeat(held, [len(x) for x in some])
        counts = np.bincount(np.concatenate(some)[~out], minlength=len(words.table))
        marked = np.sort(pairs_of(some, words.table) << np.uint64(1) | out.astype(np.uint64))
        pairs = marked >> np.uint64(1)
        first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        pairs, times = pairs[first], np.add.reduceat(1 - (marked & np.uint64(1)).astype(np.int64), first)
        g = table.column("g")[0].as_py()
        rows = [(k, g, 1, packed(words.table[at]), counts[at].astype("<u4").tobytes()) for k, at in exchange.split(words.table, n)]
        rows += [(k, g, 2, packed(pairs[at] // np.uint64(n)), times[at].astype("<u4").tobytes()) for k, at in split_pairs(pairs, n)]
        return exchange.table_of(ASK, list(zip(*rows, strict=True)))

    return exchange.per_group(docs, ASK, each)


def answers(asked: DataFrame) -> DataFrame:
    """A bucket counts its n-grams, fills its segment of the filter with all of them, and answers each group in
    the order of its keys: words' exact counts, and levels read from the segment. How many n-grams each level has goes to
    a group of its own, past those of documents."""
    beyond = exchange.GROUPS * exchange.partitions(asked)

    def each(rows: list[dict]):
        for order in (1, 2):
            mine = [r for r in rows if r["ngram"] == order]
            if not mine:
                continue
            keys = [unpacked(r["keys"]) for r in mine]
            every, sums = total(np.concatenate(keys), np.concatenate([np.frombuffer(r["counts"], "<u4").astype(np.int64) for r in mine]))
            known = sums > 0
            q = levels(sums[known])
            read = Filter({(order, 0): segment(every[known], q)}, 1, {}, 0, 0).level(every, order).astype(np.uint8) if known.any() else np.zeros(len(every), np.uint8)
            for r, k in zip(mine, keys, strict=True):
                at = np.searchsorted(every, k)
                yield r["g"], r["bucket"], order, sums[at].astype("<u8").tobytes() if order == 1 else None, read[at].tobytes(), None, None, None
            for level in np.unique(q):
                yield beyond + mine[0]["bucket"], mine[0]["bucket"], order, None, None, int(level), int((q == level).sum()), int(sums[known][q == level].sum())

    return exchange.per_bucket(asked, ANSWER, each)


READ = "doc_id long, held boolean, n_tokens long, n_known long, logs double, cells binary, times binary, ngram int, level int, ngrams long, mass long"


def read(docs: DataFrame, got: DataFrame) -> DataFrame:
    """Documents with their base sums and cells, and the levels' sizes, passed on. A cell is a token's
    level of the word before, own level and level of the pair, a byte each."""
    n = exchange.partitions(docs)

    def each(table, got):
        rows = got.to_pylist()
        if not table.num_rows:
            out = [(*[None] * 7, r["ngram"], r["level"], r["ngrams"], r["mass"]) for r in rows]
            return exchange.table_of(READ, list(zip(*out, strict=True)))
        answer = {(r["ngram"], r["bucket"]): r for r in rows}
        words = Words()
        some = words.numbers(table.column("b").to_pylist())
        exact, own = np.zeros(len(words.table), np.int64), np.zeros(len(words.table), np.uint64)
        for k, at in exchange.split(words.table, n):
            exact[at] = np.frombuffer(answer[1, k]["counts"], "<u8")
            own[at] = np.frombuffer(answer[1, k]["levels"], np.uint8)
        pairs, where = np.unique(pairs_of(some, words.table), return_inverse=True)
        both = np.zeros(len(pairs), np.uint64)
        for k, at in split_pairs(pairs, n):
            both[at] = np.frombuffer(answer[2, k]["levels"], np.uint8)
        x, sizes = np.concatenate(some), np.array([len(s) for s in some])
        before = np.concatenate([[0], x[:-1]])
        before[np.cumsum(sizes) - sizes] = 0  # the end token stands before a first word
        h, w = own[before], own[x]
        cell = h << np.uint64(16) | w << np.uint64(8) | np.where((h > 0) & (w > 0), both[where], np.uint64(0))
        cells, times = np.unique(np.repeat(np.arange(len(some), dtype=np.uint64), sizes) << np.uint64(24) | cell, return_counts=True)
        edges = np.searchsorted(cells >> np.uint64(24), np.arange(len(some) + 1, dtype=np.uint64))
        cells, times = (cells & np.uint64(0xFFFFFF)).astype("<u4"), times.astype("<u4")
        logs = np.log10(exact + 1.0)
        out = [
            (d, held, len(s), int((exact[s] > 0).sum()), float(logs[s].sum()), cells[i:j].tobytes(), times[i:j].tobytes(), *[None] * 4)
            for d, held, s, i, j in zip(table.column("doc_id").to_pylist(), table.column("held").to_pylist(), some, edges[:-1], edges[1:], strict=True)
        ]
        return exchange.table_of(READ, list(zip(*out, strict=True)))

    return exchange.per_group_with(docs, got, READ, each)


def places(keys: np.ndarray, level: np.ndarray | int, bits: int) -> np.ndarray:
    """(keys, PROBES) bit numbers inside a segment."""
    with np.errstate(over="ignore"):
        a = common.mix64(keys + np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, np.uint64))
        b = common.mix64(a) | np.uint64(1)
        return ((a[:, None] + b[:, None] * np.arange(PROBES, dtype=np.uint64)) >> np.uint64(8)) % np.uint64(bits)


class Filter:
    """Segments of (order, bucket), and the levels' mean counts."""

    def __init__(self, segments: dict, buckets: int, means: dict, n: int, v: int):
        self.buckets, self.means, self.n, self.v = buckets, means, n, v
        self.start, self.bits = np.zeros((3, buckets), np.int64), np.full((3, buckets), 8, np.int64)
        at, raw = 0, []
        for (order, bucket), seg in sorted(segments.items()):
            self.start[order, bucket], self.bits[order, bucket] = at, 8 * len(seg)
            raw.append(seg)
            at += len(seg)
        self.raw = np.frombuffer(b"".join(raw) + b"\0", np.uint8)
        self.live = {o: any(k == o for k, _ in segments) for o in (1, 2)}

    def level(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Level by level, as long as all probes of a level hit."""
        out = np.zeros(len(keys), np.int64)
        if not self.live[order]:
            return out
        bucket = ((keys >> np.uint64(33)) % np.uint64(self.buckets)).astype(np.int64)
        bits, start = self.bits[order][bucket].astype(np.uint64), self.start[order][bucket]
        alive = np.flatnonzero(bits > 8)
        for q in range(1, LEVELS):
            if not len(alive):
                break
            with np.errstate(over="ignore"):
                a = common.mix64(keys[alive] + np.uint64(0x9E3779B97F4A7C15) * np.uint64(q))
                b = common.mix64(a) | np.uint64(1)
            hit = np.ones(len(alive), bool)
            for k in range(PROBES):
                left = np.flatnonzero(hit)
                with np.errstate(over="ignore"):
                    bit = (((a[left] + b[left] * np.uint64(k)) >> np.uint64(8)) % bits[alive[left]]).astype(np.int64)
                hit[left] = self.raw[start[alive[left]] + (bit >> 3)] >> (bit & 7).astype(np.uint8) & 1 > 0
            alive = alive[hit]
            out[alive] = q
        return out


def segment(keys: np.ndarray, q: np.ndarray) -> bytes:
    """The bits of n-grams of levels q, as many as they need."""
    size = max(2, -(-int(q.sum()) * BITS // 8))
    bits = np.zeros(size * 8, np.uint8)
    for level in range(1, int(q.max(initial=0)) + 1):
        bits[places(keys[q >= level], level, size * 8).ravel()] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def least_count_level(hist: list[tuple[int, int, int]], max_bytes: int = MAX_BYTES) -> int:
    """The smallest level at which the n-grams of that level or more fit a bound. The operator has no
    bound and does not ask."""
    for least in range(1, LEVELS):
        if sum(q * n for _, q, n in hist if q >= least) * BITS <= max_bytes * 8:
            return least
    return LEVELS


class Model:
    """The levels' mean counts, N, V and the weights k by the level of h."""

    def __init__(self, sizes: list[tuple[int, int, int, int]]):
        self.means = {o: np.zeros(LEVELS + 1) for o in (1, 2)}
        for o, q, k, mass in sizes:
            self.means[o][q] = mass / k
        self.n, self.v = (sum(r[c] for r in sizes if r[0] == 1) for c in (3, 2))
        self.weights = np.zeros(LEVELS + 1)


def parts(model: Model, cells: np.ndarray, less: int = 0):
    """(level of h, pair estimate, single-word estimate), ``less`` taken off the counts."""
    h, w, both = (cells.astype(np.int64) >> shift & 255 for shift in (16, 8, 0))
    likely = np.minimum(1.0, np.maximum(model.means[2][both] - less, 0) / np.maximum(model.means[1][h] - less, 1))
    return h, likely, (np.maximum(model.means[1][w] - less, 0) + 1) / (model.n + model.v + 1)


def set_weights(model: Model, cells: np.ndarray, times: np.ndarray, rounds: int = 20) -> None:
    """Deleted interpolation: k of each level by expectation maximisation."""
    if not len(cells):
        return
    history, likely, single = parts(model, cells, 1)
    seen = np.bincount(history, times, LEVELS + 1)
    k = np.full(LEVELS + 1, 0.5)
    for _ in range(rounds):
        a = k[history] * likely
        k = np.bincount(history, times * a / (a + (1 - k[history]) * single), LEVELS + 1) / np.maximum(seen, 1)
        k = np.minimum(k, 0.999)
    model.weights = np.where(seen > 0, k, 0.0)
    model.weights[0] = 0.0


CELLS = "cell long, times long"


def cell_counts(base: DataFrame) -> DataFrame:
    """(cell, times) over all tokens of documents."""

    def run(batches):
        cells, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            more = [np.frombuffer(b"".join(c.to_pylist()), "<u4").astype(np.int64) for c in batch.columns]
            if len(more[0]):
                cells, times = total(np.concatenate([cells, more[0]]), np.concatenate([times, more[1]]))
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(times)], names=["cell", "times"])

    return base.select("cells", "times").mapInArrow(run, CELLS).groupBy("cell").agg(F.sum("times").alias("times"))


def train(docs: DataFrame, held) -> tuple[Model, DataFrame]:
    """The model, and the documents' base sums and cells."""
    common.prepare(docs.sparkSession)
    mine = exchange.grouped(docs, held.alias("held"))
    found = common.stored(read(mine, answers(ask(mine))), "cells")
    sizes = found.where("level is not null").groupBy("ngram", "level").agg(F.sum("ngrams"), F.sum("mass")).collect()
    model, base = Model([tuple(r) for r in sizes]), found.where("level is null")
    some = cell_counts(base.where("not held")).collect()  # at most LEVELS ** 3 rows
    set_weights(model, np.array([r["cell"] for r in some], np.int64), np.array([r["times"] for r in some], np.int64))
    return model, base


def score(base: DataFrame, model: Model) -> DataFrame:
    """Base and model score of each row."""
    shared = base.sparkSession.sparkContext.broadcast(model)  # a few numbers a level
    n, v = model.n, model.v

    def start():
        use = shared.value

        def step(batch):
            if not batch.num_rows:
                return None
            d, held, tokens, known, logs, cells, times = batch.columns
            cells = cells.to_pylist()
            begins = np.cumsum([0, *(len(c) // 4 for c in cells[:-1])])
            history, likely, single = parts(use, np.frombuffer(b"".join(cells), "<u4"))
            k = use.weights[history]
            by = np.frombuffer(b"".join(times.to_pylist()), "<u4") * np.log10(k * likely + (1 - k) * single)
            base_score = logs.to_numpy(zero_copy_only=False) - tokens.to_numpy(zero_copy_only=False) * np.log10(n + v + 1)
            return [d, held, tokens, known, np.full(len(cells), n), base_score, np.add.reduceat(by, begins)]

        return step

    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return common.mapped(base.select("doc_id", "held", "n_tokens", "n_known", "logs", "cells", "times"), out, start)


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model, base = train(docs, common.split_of(F.col("doc_id"), HOLD_MOD) == HOLD_AT)
    return score(base, model)
