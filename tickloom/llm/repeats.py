"""Repeated-passage removal by a run-length index (r-index) and matching statistics.

A byte goes if a string of ``LENGTH`` = 50 bytes covers it that also starts in a
document of smaller id. Three steps, all over whole texts:

Exact copies of a whole text are folded first: copies of the one with the least id go whole. Groups
of documents ask about their different texts, so that a text with very many copies is a few rows. Then:

1. Every 50-byte window has one anchor: of the 16-byte strings inside it, the
   leftmost of least hash. Windows with the anchor at nearly the same place (18 places) share the 33 or 34 bytes
   around it that all of them have; those bytes name a class. Equal windows are in one class, so only windows
   whose class occurs in two documents can repeat; sixteen bytes alone would meet by chance ever oftener as
   tables grow. Groups ask buckets about their different classes (exchange.py), by 40 bits of the names, close together; the
   answer is a bit each. Names that are alike in these bits only cost a piece sent in vain.
2. Neighbouring windows of one such anchor make a piece of at most 84 bytes. A bucket gets each
   different piece of its anchors with the least id that has it. The member of least id stands for
   its class: such members are indexed, in slabs of ``SLAB`` bytes, by their run-compressed
   Burrows-Wheeler transform with text positions sampled at both ends of every run. The class's other members
   are streamed through the index from their ends, all at once, one byte a step:
   matching statistics by last-to-first steps; where the next byte is not the run's, the walk goes on
   from the nearer of the two neighbouring runs of that byte.
3. Where a match has 50 or more bytes, the indexed member's id is the window's least. Windows without
   a match go on to narrower classes (18, 6, 2 and 1 places of the anchor), of
   which the last hold equal windows only. Least ids come back to the
   groups, which mark the windows of documents with a greater id.

Rows with a null id are left whole and remove nothing; empty and null texts, and texts under 50
bytes, are never touched; equal ids do not remove from each other, but rows of one id are judged each by
its own text.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import common, exchange

LENGTH, ANCHOR = 50, 16
TWO = np.uint64(1)  # in a key that is asked: two documents have it
SPREAD = LENGTH - ANCHOR + 1
#: Bytes of text that are anchored, and indexed or streamed, at a time.
CHUNK, SLAB = 1 << 21, 1 << 19
#: Places of the anchor that a class spans, wide classes first.
WIDTHS = (18, 6, 2, 1)
#: Bytes of a part of the widest class.
PART = LENGTH + WIDTHS[0] - 1
#: Bits of the keys that groups ask by, and how many of them are the anchor's and give the bucket.
KEY_BITS, BUCKET_BITS = 40, 18
NONE = np.iinfo(np.int64).max


def anchor_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR bytes from each position on."""
    n = len(text) - ANCHOR + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = np.ndarray((len(text) - 7,), "<u8", np.ascontiguousarray(text).data, strides=(1,)).copy()
    with np.errstate(over="ignore"):
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        return common.mix64(x[:n] + x[8 : n + 8] * np.uint64(0xD6E8FEB86659FD93))


def windows(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of a text made of documents that end at ``ends``: (first window, last window, anchor
    hash, document, place of the anchor) of each run of windows that share an anchor."""
    h = anchor_hashes(text)
    n = len(text) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while span * 2 <= SPREAD:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    at = (np.minimum(low[:n], low[SPREAD - span : SPREAD - span + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    new = np.ones(n, bool)
    new[1:] = at[1:] != at[:-1]
    new[begins[begins < n]] = True
    past = ends - LENGTH + 1  # windows from here on run past the document's end
    new[past[(past > 0) & (past < n)]] = True
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [n]]) - 1
    doc = np.searchsorted(ends, first, "right")
    keep = first + LENGTH <= ends[doc]
    first, last, doc = first[keep], last[keep], doc[keep]
    return first, last, h[at[first]], doc, at[first] - first


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (count[0] of them), begin[1], ..."""
    return np.repeat(begin - np.cumsum(count) + count, count) + np.arange(int(count.sum()))


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on."""
    return np.ndarray((max(0, len(text) - 7),), "<u8", np.ascontiguousarray(text).data, strides=(1,))


def hashes(words: np.ndarray, begin: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """Hash of the ``size`` bytes, 8 to ``most``, from each ``begin`` on."""
    out = size.astype(np.uint64)
    for k in range(0, most, 8):
        with np.errstate(over="ignore"):
            out = common.mix64(out * np.uint64(0x9E3779B97F4A7C15) + words[begin + np.minimum(k, size - 8)])
    return out


def cut(most: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows in which the anchor's place falls from ``most`` to ``least``, cut where a class of the widest
    kind ends: (run, most, least) of each part."""
    width = WIDTHS[0]
    count = most // width - least // width + 1
    run = np.repeat(np.arange(len(most)), count)
    low = (most[run] // width - spread(np.zeros(len(count), np.int64), count)) * width
    return run, np.minimum(most[run], low + width - 1), np.maximum(least[run], low)


def pieces(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``windows``, with their runs cut into parts of one class."""
    first, last, h, doc, place = windows(text, ends)
    run, most, least = cut(place, place - (last - first))
    anchor = (first + place)[run]
    return anchor - most, anchor - least, h[run], doc[run], most


def class_keys(text: np.ndarray, first: np.ndarray, h: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Key of each part's class: bits of the anchor's hash, then of the name. Equal windows have equal keys; the lowest bit is 0."""
    low = place // WIDTHS[0] * WIDTHS[0]
    high = np.minimum(low + WIDTHS[0], SPREAD) - 1
    name = hashes(words_at(text), first + place - low, LENGTH - high + low, LENGTH) ^ low.astype(np.uint64)
    rest = KEY_BITS - BUCKET_BITS
    return (common.mix64(h) >> np.uint64(64 - BUCKET_BITS) << np.uint64(rest) | name >> np.uint64(64 - rest)) << np.uint64(1)


def split(keys: np.ndarray, n: int):
    """(bucket, which of the ascending keys are its own). A bucket is a range of keys, so that differences are small, and has
    all classes of its anchors."""
    bucket = (keys >> np.uint64(KEY_BITS - BUCKET_BITS + 1)) * np.uint64(n) >> np.uint64(BUCKET_BITS)
    edges = np.searchsorted(bucket, np.arange(n + 1, dtype=np.uint64))
    return ((k, slice(edges[k], edges[k + 1])) for k in range(n) if edges[k] < edges[k + 1])


def pack(x: np.ndarray) -> bytes:
    """64-bit numbers, compressed with bytes of one rank together."""
    return zstandard.compress(x.view("u1").reshape(-1, 8).T.tobytes(), 3)


def unpack(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(np.frombuffer(zstandard.decompress(raw), "u1").reshape(8, -1).T.tobytes(), kind)


class Index:
    """r-index of texts: run-length BWT and text positions at run ends.

    A separator stands before, between and after the texts. Separators are smaller than all bytes
    and differ from each other, in the order of their places.
    """

    def __init__(self, raw: np.ndarray, size: np.ndarray):
        owner = np.repeat(np.arange(len(size)), size)
        inside = np.arange(len(owner)) + owner + 1
        n = len(raw) + len(size) + 1
        self.text, self.left, self.owner = np.zeros(n, np.uint8), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.text[inside], self.owner[inside] = raw, owner
        self.left[inside] = np.repeat(np.cumsum(size), size) - np.arange(len(owner))  # bytes up to the next separator; 0 is a separator
        rank, depth = self._rank8(), 8
        while depth < int(self.left.max()):
            ahead, more = np.zeros(n, np.int64), np.flatnonzero(self.left > depth)
            ahead[more] = rank[more + depth] + 1
            rank = dense(rank * (n + 1) + ahead)
            depth *= 2
        order = np.argsort(rank * (n + 1) + np.arange(n))  # ties by place
        symbol = np.where(self.left > 0, self.text.astype(np.int16) + 1, 0)
        bwt = symbol[order - 1]
        self.begin = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        end = np.concatenate([self.begin[1:], [n]]) - 1
        self.head = bwt[self.begin]
        self.end, self.first_sample, self.last_sample = end, order[self.begin], order[end]
        size = end - self.begin + 1
        by = np.argsort(self.head, kind="stable")  # runs of a symbol keep their order in its block
        self.to = np.empty(len(size), np.int64)
        self.to[by] = np.cumsum(size[by]) - size[by]
        self.runs = {int(c): np.flatnonzero(self.head == c) for c in np.unique(self.head)}

    def _rank8(self) -> np.ndarray:
        padded = np.concatenate([self.text, np.zeros(8, np.uint8)])
        word = np.ndarray((len(self.text),), ">u8", padded.data, strides=(1,)).astype(np.uint64)
        kept = np.minimum(self.left, 8)
        word[kept == 0] = 0
        word &= ~np.uint64(0) << (np.uint64(64) - np.maximum(kept, 1).astype(np.uint64) * np.uint64(8))
        # Without zero bytes in the text, the zeros that fill a word tell how many bytes it has.
        order = np.lexsort((kept, word)) if (self.text[self.left > 0] == 0).any() else np.argsort(word)
        step = (word[order][1:] != word[order][:-1]) | (kept[order][1:] != kept[order][:-1])
        out = np.zeros(len(word), np.int64)
        out[order[1:]] = np.cumsum(step)
        return out

    def common_length(self, p: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Bytes that the text has alike from p and q on, at most ``most``."""
        width = int(most.max(initial=0))
        if not width:
            return np.zeros(len(p), np.int64)
        k = np.arange(width)
        a, b = np.minimum(p[:, None] + k, len(self.text) - 1), np.minimum(q[:, None] + k, len(self.text) - 1)
        same = (self.text[a] == self.text[b]) & (self.left[a] > 0) & (self.left[b] > 0) & (k < most[:, None])
        return np.where(same.all(1), width, np.argmin(same, axis=1))

    def statistics(self, raw: np.ndarray, size: np.ndarray):
        """Matching statistics of all patterns together, from their ends: yields, for each step,
        (patterns, place in pattern, match length, text position of the match)."""
        ends = np.cumsum(size)
        flat = raw.astype(np.int64) + 1
        row, place, length = (np.zeros(len(size), np.int64) for _ in range(3))
        order = np.argsort(-size, kind="stable")
        sorted_size = -size[order]
        for t in range(int(size.max(initial=0))):
            live = order[: np.searchsorted(sorted_size, -t, "left")]
            symbol = flat[ends[live] - 1 - t]
            run = np.searchsorted(self.begin, row[live], "right") - 1
            miss = np.flatnonzero((self.head[run] != symbol) | (length[live] == 0))
            for c in np.unique(symbol[miss]):
                k = miss[symbol[miss] == c]
                who, own = live[k], self.runs.get(int(c))
                if own is None:  # a byte that the index has not
                    length[who], row[who], run[k] = -1, 0, 0
                    continue
                at = np.searchsorted(own, run[k])
                above, below = own[np.maximum(at - 1, 0)], own[np.minimum(at, len(own) - 1)]
                up, down = self.last_sample[above], self.first_sample[below]
                most = length[who]
                by_up, by_down = self.common_length(place[who], up, most), self.common_length(place[who], down, most)
                use = by_up > by_down
                run[k] = np.where(use, above, below)
                row[who] = np.where(use, self.end[above], self.begin[below])
                place[who] = np.where(use, up, down)
                length[who] = np.where(use, by_up, by_down)
            row[live] = np.where(length[live] >= 0, self.to[run] + row[live] - self.begin[run], 0)
            place[live] -= 1
            length[live] += 1
            yield live, size[live] - 1 - t, length[live], place[live]


def dense(key: np.ndarray) -> np.ndarray:
    """Ranks of the keys; equal keys have equal ranks."""
    order = np.argsort(key)
    out = np.zeros(len(key), np.int64)
    out[order[1:]] = np.cumsum(key[order][1:] != key[order][:-1])
    return out


def least_ids(raw: np.ndarray, begin: np.ndarray, size: np.ndarray, place: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each piece, the least id over all pieces that have its 50 bytes: (least ids of
    all windows, first window of each piece). A piece is ``size`` bytes of ``raw`` from ``begin`` on, its anchor at
    ``place``; pieces differ."""
    count = size - LENGTH + 1
    start = np.cumsum(count) - count
    piece = np.repeat(np.arange(len(size)), count)
    least = ids[piece]
    offset = place[piece] - (np.arange(len(piece)) - start[piece])  # of the anchor in the window
    words, rest = words_at(raw), np.arange(len(piece))
    for width in WIDTHS:
        if not len(rest):
            break
        # Parts: a piece's windows of one class; the anchor's place falls from window to window.
        band, own = offset[rest] // width, piece[rest]
        edge = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (band[1:] != band[:-1])]))
        first, last = rest[edge], rest[np.append(edge[1:], len(rest)) - 1]
        own, low = own[edge], band[edge] * width
        high = np.minimum(low + width, SPREAD) - 1
        name = hashes(words, begin[own] + place[own] - low, LENGTH - high + low, LENGTH) ^ low.astype(np.uint64)
        order = np.lexsort((ids[own], name))
        new = np.concatenate([[True], name[order][1:] != name[order][:-1]])
        group, many = np.cumsum(new) - 1, np.diff(np.flatnonzero(np.append(new, True))) > 1
        stands, others = order[new][many], order[~new]
        if not len(others):
            break
        part = np.cumsum(many)[group[~new]] - 1  # which of ``stands`` stands for the class
        at, bytes_ = begin[own] + first - start[own], last - first + LENGTH
        slab = np.cumsum(bytes_[stands]) // SLAB
        done = np.zeros(len(piece), bool)
        for k in range(int(slab[-1]) + 1):
            these = stands[slab == k]
            if not len(these):
                continue
            index = Index(raw[spread(at[these], bytes_[these])], bytes_[these])
            mine = others[slab[part] == k]
            turn = np.cumsum(bytes_[mine]) // (4 * SLAB)
            for t in range(int(turn[-1]) + 1):
                some = mine[turn == t]
                if not len(some):
                    continue
                for who, where, length, found in index.statistics(raw[spread(at[some], bytes_[some])], bytes_[some]):
                    hit = length >= LENGTH
                    if hit.any():
                        w = first[some[who[hit]]] + where[hit]
                        least[w] = np.minimum(least[w], ids[own[these[index.owner[found[hit]]]]])
                        done[w] = True
        # A window that met nothing may still be like another's that stands for no class.
        rest = rest[np.isin(np.repeat(np.arange(len(own)), np.diff(np.append(edge, len(rest)))), others)]
        rest = rest[~done[rest]]
    return least, start


def text_hash():
    return F.unhex(F.md5(common.body(F.col("text")))).alias("h")


def copies(docs: DataFrame) -> DataFrame:
    """(g, texts, leasts): hashes of a group's texts that a smaller id has too, and that id, packed. Each group has a
    text once, however many copies it has; ids and hashes move, texts do not."""
    mine = exchange.dealt(docs, text_hash()).where((F.octet_length("b") >= LENGTH) & F.col("doc_id").isNotNull())
    each = mine.groupBy("g", "h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    first = each.groupBy("h").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least < most").select(F.col("h").alias("t"), "least")
    later = each.join(first, F.col("h") == F.col("t")).where("high > least")
    return later.groupBy("g").agg(F.collect_list(F.struct("h", "least")).alias("copies")).select((F.col("g") + 0).alias("g"), F.col("copies.h").alias("texts"), F.col("copies.least").alias("leasts"))


def member(known: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of x are in the ascending array ``known``."""
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def told(table, got) -> tuple[set[int], list[dict]]:
    """(places of whole copies among a group's rows, the other answers)."""
    rows = got.to_pylist()
    least = {t: i for r in rows if r["texts"] is not None for t, i in zip(r["texts"], r["leasts"], strict=True)}
    names = zip(table.column("doc_id").to_pylist(), table.column("h").to_pylist(), strict=True) if least else ()
    return {k for k, (i, t) in enumerate(names) if i is not None and least.get(t, i) < i}, [r for r in rows if r["texts"] is None]


def chunks(ids: list, raw: list[bytes], whole: set[int]):
    """(places of rows, text, ends) for some documents at a time; null ids, short texts and
    whole copies are left out."""
    some, size = [], 0
    for k, (i, r) in enumerate(zip(ids, raw, strict=True)):
        if i is not None and len(r) >= LENGTH and k not in whole:
            some.append(k)
            size += len(r)
            if size >= CHUNK:
                yield some, *_joined(some, raw)
                some, size = [], 0
    if some:
        yield some, *_joined(some, raw)


def _joined(some: list[int], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(raw[k] for k in some), np.uint8), np.cumsum([len(raw[k]) for k in some])


def _blobs(rows: list[dict], name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(r[name] for r in rows), kind)


def piece_keys(text: np.ndarray, first: np.ndarray, last: np.ndarray, place: np.ndarray, most: int = 2 * LENGTH - ANCHOR) -> np.ndarray:
    """A piece's key: all its bytes, at most ``most``, and its anchor's place."""
    return hashes(words_at(text), first, last - first + LENGTH, most) ^ place.astype(np.uint64)


ASK = "bucket int, g int, keys binary"
SHARED = "g int, bucket int, hits binary"
ASK_PIECES = "bucket int, g int, ids binary, shapes binary, raw binary"
LEAST = "g int, keys binary, windows binary, runs binary, run_ids binary"


def shared_anchors(docs: DataFrame, same: DataFrame) -> DataFrame:
    """For each group and bucket, which of the keys asked (anchors with the bytes around them) two or more documents have."""
    n = exchange.partitions(docs)

    def ask(table, got):
        ids = table.column("doc_id").to_pylist()
        whole, _ = told(table, got)
        found = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for some, text, ends in chunks(ids, table.column("b").to_pylist(), whole):
            first, _, h, doc, place = pieces(text, ends)
            found[0].append(class_keys(text, first, h, place))
            found[1].append(np.array([ids[k] for k in some], np.int64)[doc])
        keys, own = np.concatenate(found[0]), np.concatenate(found[1])
        if not len(keys):
            return exchange.table_of(ASK, [])
        order = np.lexsort((own, keys))
        keys, own = keys[order], own[order]
        start = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
        many = np.maximum.reduceat(own, start) != own[start]
        keys = keys[start] | many.astype(np.uint64)  # the low bit says: two documents already here
        g = table.column("g")[0].as_py()
        rows = [(k, g, pack(np.diff(keys[at], prepend=np.uint64(0)))) for k, at in split(keys, n)]
        return exchange.table_of(ASK, list(zip(*rows, strict=True)))

    def answer(rows):
        each = [np.cumsum(unpack(r["keys"], "<u8"), dtype=np.uint64) for r in rows]
        keys = np.concatenate(each)
        order = np.argsort(keys | TWO, kind="stable")
        value, here = (keys | TWO)[order], (keys & TWO)[order] > 0
        start = np.concatenate([[0], np.flatnonzero(value[1:] != value[:-1]) + 1])
        times = np.diff(start, append=len(value))
        twice = (times > 1) | np.logical_or.reduceat(here, start)
        hit = np.empty(len(keys), bool)
        hit[order] = np.repeat(twice, times)
        at = 0
        for r, mine in zip(rows, each, strict=True):
            hits = hit[at : at + len(mine)]
            at += len(mine)
            if hits.any():
                yield r["g"], r["bucket"], np.packbits(hits).tobytes()

    return exchange.per_bucket(exchange.per_group_with(docs, same, ASK, ask), SHARED, answer)


def least_of_windows(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """For each group, its pieces that other documents may have and the least id of each of their windows, run by run."""
    n = exchange.partitions(docs)

    def ask(table, got):
        whole, rows = told(table, got)
        if not rows or not table.num_rows:
            return exchange.table_of(ASK_PIECES, [])
        ids, raws = table.column("doc_id").to_pylist(), table.column("b").to_pylist()
        keyed = []
        for _, text, ends in chunks(ids, raws, whole):
            first, last, h, doc, place = pieces(text, ends)
            keyed.append((first, last, class_keys(text, first, h, place), doc, place))
        known = np.unique(np.concatenate([x[2] for x in keyed] or [np.zeros(0, np.uint64)]))  # as in shared_anchors
        hits = {r["bucket"]: r["hits"] for r in rows}
        hit = np.zeros(len(known), bool)
        for k, at in split(known, n):
            if k in hits:
                hit[at] = np.unpackbits(np.frombuffer(hits[k], "u1"), count=at.stop - at.start)
        known = known[hit]
        found: list[list[np.ndarray]] = [[] for _ in range(6)]
        for (some, text, _), (first, last, h, doc, place) in zip(chunks(ids, raws, whole), keyed, strict=True):
            use = np.flatnonzero(member(known, h))
            # Neighbouring parts around one place of an anchor go as one piece.
            new = np.ones(len(use), bool)
            new[1:] = (first + place)[use[1:]] != (first + place)[use[:-1]]
            last, use = last[use[np.flatnonzero(np.append(new[1:], True))]] if len(use) else last[use], use[new]
            first, h, place, whose = first[use], h[use], place[use], np.array([ids[k] for k in some], np.int64)[doc[use]]
            keys = piece_keys(text, first, last, place)
            order = np.lexsort((whose, keys))
            at = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]])) if len(keys) else np.zeros(0, np.int64)
            most = np.maximum.reduceat(whose[order], at) if len(at) else whose
            at = order[at]
            size = last[at] - first[at] + LENGTH
            for x, more in zip(found, (h[at], keys[at], whose[at], most, size << 8 | place[at], text[spread(first[at], size)]), strict=True):
                x.append(more)
        if not found[0]:
            return exchange.table_of(ASK_PIECES, [])
        h, keys, low, most, size, raw = map(np.concatenate, found)
        size, place = size >> 8, size & 255
        begin = np.cumsum(size) - size
        order = np.lexsort((low, keys))  # a piece of two chunks
        at = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]])) if len(keys) else order
        many = np.maximum.reduceat(most[order], at) > low[order][at] if len(at) else np.zeros(0, bool)
        at = order[at]
        order = np.argsort(h[at], kind="stable")
        at, many = at[order], many[order]
        g, out = table.column("g")[0].as_py(), []
        for k, mine in split(h[at], n):
            one = at[mine]
            blob = raw[spread(begin[one], size[one])].tobytes()
            out.append((k, g, pack(low[one]), zstandard.compress(np.stack([size[one], place[one], many[mine]]).astype(np.uint8).tobytes(), 3), zstandard.compress(blob, 3)))
        return exchange.table_of(ASK_PIECES, list(zip(*out, strict=True)))

    def answer(rows):
        each = [np.frombuffer(zstandard.decompress(r["shapes"]), "u1").reshape(3, -1) for r in rows]
        size, place, many = np.concatenate(each, axis=1).astype(np.int64)
        ids = np.concatenate([unpack(r["ids"], "<i8") for r in rows])
        raw = np.frombuffer(b"".join(zstandard.decompress(r["raw"]) for r in rows), np.uint8)
        begin = np.cumsum(size) - size
        keys = piece_keys(raw, begin, begin + size - LENGTH, place)
        _, one, back = np.unique(keys, return_index=True, return_inverse=True)
        low = np.full(len(one), NONE)
        np.minimum.at(low, back, ids)
        least, start = least_ids(raw, begin[one], size[one], place[one], low)
        # Parts of the pieces, in the order of ``least``; groups are answered part by part.
        run, top, bottom = cut(place[one], place[one] - (size[one] - LENGTH))
        ahead, count = place[one][run] - top, top - bottom + 1
        start, at_part, parts = start[run] + ahead, np.searchsorted(run, np.arange(len(one))), np.bincount(run, minlength=len(one))
        every = piece_keys(raw, begin[one][run] + ahead, begin[one][run] + ahead + count - 1, top, PART)
        lowest = np.minimum.reduceat(least, start) if len(start) else least
        at = 0
        for r, shape in zip(rows, each, strict=True):
            n = shape.shape[1]
            whole = back[at : at + n]
            mine, asked = spread(at_part[whole], parts[whole]), np.repeat(np.arange(at, at + n), parts[whole])
            at += n
            mine = mine[(many[asked] > 0) | (lowest[mine] < ids[asked])]  # an answer that removes nothing in its group is not sent
            mine = mine[np.unique(every[mine], return_index=True)[1]]
            if not len(mine):
                continue
            flat = least[spread(start[mine], count[mine])]
            edge = np.zeros(len(flat), bool)
            edge[np.cumsum(count[mine]) - count[mine]] = True
            edge[1:] |= flat[1:] != flat[:-1]
            runs = np.flatnonzero(edge)
            yield r["g"], every[mine].tobytes(), count[mine].astype(np.uint8).tobytes(), np.diff(runs, append=len(flat)).astype(np.uint8).tobytes(), pack(flat[runs])

    return exchange.per_bucket(exchange.per_group_with(docs, shared, ASK_PIECES, ask), LEAST, answer)


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, starts binary, ends binary"


def marked(docs: DataFrame, least: DataFrame) -> DataFrame:
    """Each document with its removed spans and what is left."""

    def each(table, got):
        whole, rows = told(table, got)
        ids, raw = table.column("doc_id").to_pylist(), table.column("b").to_pylist()
        spans: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if rows and len(ids):
            keys, runs = _blobs(rows, "keys", "<u8"), _blobs(rows, "runs", "u1")
            run_ids = np.concatenate([unpack(r["run_ids"], "<i8") for r in rows])
            order = np.argsort(keys)
            ordered = keys[order]
            flat = np.repeat(run_ids, runs)
            count = _blobs(rows, "windows", "u1").astype(np.int64)
            starts = np.cumsum(count) - count
            for some, text, ends in chunks(ids, raw, whole):
                first, last, _, doc, place = pieces(text, ends)
                mine = piece_keys(text, first, last, place, PART)
                use = member(ordered, mine)
                if use.any():
                    at = order[np.searchsorted(ordered, mine[use])]
                    spans.update(_spans(some, ends, first[use], last[use], doc[use], np.array([ids[k] for k in some], np.int64), flat, at, starts))
        out = []
        for k, (i, r) in enumerate(zip(ids, raw, strict=True)):
            a, b = spans.get(k, (np.zeros(0, np.int64),) * 2)
            if k in whole:
                a, b = np.array([0]), np.array([len(r)])
            left = b"".join(r[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(r)], strict=True)) if len(a) else r
            out.append((i, len(r), len(r) - len(left), len(a), left, a.astype("<i8").tobytes(), b.astype("<i8").tobytes()))
        return exchange.table_of(REMOVED, list(zip(*out, strict=True)))

    return exchange.per_group_with(docs, least, REMOVED, each)


def _spans(some, ends, first, last, doc, ids, flat, at, starts) -> dict:
    """Maximal runs of bytes under windows whose least id is smaller than the document's."""
    count = last - first + 1
    low = flat[spread(starts[at], count)]
    where, whose = spread(first, count), np.repeat(doc, count)
    bad = low < ids[whose]
    where, whose = where[bad], whose[bad]
    if not len(where):
        return {}
    new = np.concatenate([[True], (where[1:] > where[:-1] + LENGTH) | (whose[1:] != whose[:-1])])
    begin = np.flatnonzero(new)
    stop = np.concatenate([begin[1:], [len(where)]]) - 1
    base = np.concatenate([[0], ends[:-1]])[whose[begin]]
    a, b, owner = where[begin] - base, where[stop] + LENGTH - base, whose[begin]
    every, at = np.unique(owner, return_index=True)
    return {some[d]: x for d, x in zip(every.tolist(), zip(np.split(a, at[1:]), np.split(b, at[1:]), strict=True), strict=True)}


def without_repeats(docs: DataFrame) -> DataFrame:
    """REMOVED rows for every row of ``docs`` (doc_id, text)."""
    common.prepare(docs.sparkSession)
    mine = exchange.grouped(docs, text_hash())
    same = copies(docs)
    shared = shared_anchors(mine, same).unionByName(same, allowMissingColumns=True)
    least = least_of_windows(mine, shared)
    return marked(mine, least.unionByName(same, allowMissingColumns=True))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
