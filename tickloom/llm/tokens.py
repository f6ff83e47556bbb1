"""Token ids in patched frame-of-reference blocks.

File format, little-endian: ``PFR1``, uint32 count of ids, uint32 count of
blocks, then one uint32 start offset for each block (from the file's first
byte), then the blocks. A block holds up to 1024 ids: uint32 minimum, uint16
ids, uint8 width, uint8 zero, uint16 exceptions, uint16 zero; the ids less the
minimum packed ``width`` bits each, low bit first; then the exceptions, uint16
places and uint32 values. ``width`` is that of the 95th percentile unless
fewer bits in all are reached by packing every value; outliers are kept as
zeros in the packed part and whole in the exception list. The block index
lets a reader decode any range of ids alone.

Files are rows of a Parquet table (Spark is the only writer that every store
accepts), ordered by (part, chunk); texts are dealt to parts by ranges of
doc_id, and by a hash of the text where ids are equal. Null texts are empty and have the end id only. Rows of
equal doc_id stay neighbours; null ids come first. Empty tables give no files.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm import common

BLOCK, PERCENTILE, END_ID = 1024, 95, 2
#: Ids after which a chunk (one file) is closed.
CHUNK_IDS = 1 << 18
#: Pieces remembered by a worker before it starts anew.
PIECES = 3 << 18
_STATE: dict = {}
HEAD = np.dtype([("low", "<u4"), ("n", "<u2"), ("width", "u1"), ("z", "u1"), ("extra", "<u2"), ("z2", "<u2")])


def packed(rest: np.ndarray, width: int) -> np.ndarray:
    """Rows of values, ``width`` bits each, low bit first: a row of bytes for each row."""
    if width in (8, 16, 32):
        return np.ascontiguousarray(rest.astype(f"<u{width // 8}")).view(np.uint8)
    wide = 16 if width < 16 else 32
    bits = np.unpackbits(rest.astype(f"<u{wide // 8}").view(np.uint8).reshape(*rest.shape, wide // 8), axis=2, bitorder="little")[:, :, :width]
    return np.packbits(bits.reshape(len(rest), -1), axis=1, bitorder="little")


def unpacked(rows: np.ndarray, n: int, width: int) -> np.ndarray:
    """The inverse: ``n`` values of each row."""
    if width in (8, 16, 32):
        return np.ascontiguousarray(rows).view(f"<u{width // 8}").astype(np.uint32)
    wide = 16 if width < 16 else 32
    bits = np.zeros((len(rows), n, wide), np.uint8)
    bits[:, :, :width] = np.unpackbits(rows, axis=1, bitorder="little")[:, : n * width].reshape(len(rows), n, width)
    return np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little").view(f"<u{wide // 8}").astype(np.uint32)


def _blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of one length, a row of ids each; blocks of one width are packed together."""
    size = ids.shape[1]
    low = ids.min(1)
    rest = ids - low[:, None]
    top = _bits(rest.max(1))
    rank = min(size - 1, size * PERCENTILE // 100)
    width = _bits(np.partition(rest, rank, axis=1)[:, rank])
    outlying = rest.astype(np.uint64) >> width[:, None].astype(np.uint64) > 0
    extra = outlying.sum(1)
    whole = width * size + 48 * extra >= top * size
    width, extra = np.where(whole, top, width), np.where(whole, 0, extra)
    outlying[whole] = False
    head = np.zeros(len(ids), HEAD)
    for name, value in (("low", low), ("n", size), ("width", width), ("extra", extra)):
        head[name] = value
    kept = np.where(outlying, np.uint32(0), rest)
    out: list[bytes] = [b""] * len(ids)
    for w in np.unique(width):
        some = np.flatnonzero(width == w)
        for k, row in zip(some.tolist(), packed(kept[some], int(w)), strict=True):
            at = np.flatnonzero(outlying[k]) if extra[k] else np.zeros(0, np.int64)
            out[k] = head[k].tobytes() + row.tobytes() + at.astype("<u2").tobytes() + rest[k, at].astype("<u4").tobytes()
    return out


def _bits(x: np.ndarray) -> np.ndarray:
    """Bit length of each value."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def encode(ids: np.ndarray) -> bytes:
    """One file of the format above."""
    ids = np.asarray(ids, np.uint32)
    full = len(ids) // BLOCK * BLOCK
    blocks = _blocks(ids[:full].reshape(-1, BLOCK)) if full else []
    if full < len(ids):
        blocks += _blocks(ids[None, full:])
    starts = 12 + 4 * len(blocks) + np.cumsum([0, *map(len, blocks)])[:-1]
    return b"PFR1" + np.array([len(ids), len(blocks)], "<u4").tobytes() + starts.astype("<u4").tobytes() + b"".join(blocks)


def _values(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of neighbouring blocks; those of one length and width are unpacked together."""
    heads = np.array([np.frombuffer(raw, HEAD, 1, int(at))[0] for at in starts], HEAD)
    sizes = heads["n"].astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint32)
    kinds = sizes * 64 + heads["width"]
    data, at = np.frombuffer(raw, np.uint8), starts.astype(np.int64) + HEAD.itemsize
    for kind in np.unique(kinds):
        n, width = int(kind) // 64, int(kind) % 64
        some = np.flatnonzero(kinds == kind)
        rows = data[at[some, None] + np.arange((n * width + 7) // 8)]
        out[begin[some, None] + np.arange(n)] = unpacked(rows, n, width)
    for k in np.flatnonzero(heads["extra"]):
        extra, from_ = int(heads["extra"][k]), int(at[k]) + (int(sizes[k]) * int(heads["width"][k]) + 7) // 8
        out[begin[k] + np.frombuffer(raw, "<u2", extra, from_)] = np.frombuffer(raw, "<u4", extra, from_ + 2 * extra)
    return out + np.repeat(heads["low"], sizes)


def decode(raw: bytes, start: int = 0, n: int | None = None) -> np.ndarray:
    """Ids [start, start + n), by the block index; all of them by default."""
    if raw[:4] != b"PFR1":
        raise ValueError("not a PFR1 file")
    total, count = np.frombuffer(raw, "<u4", 2, 4)
    starts = np.frombuffer(raw, "<u4", int(count), 12)
    stop = int(total) if n is None else min(int(total), start + n)
    if start >= stop:
        return np.zeros(0, np.uint32)
    first = start // BLOCK
    ids = _values(raw, starts[first : -(-stop // BLOCK)])
    return ids[start - first * BLOCK : stop - first * BLOCK]


class Pieces:
    """Ids of the pieces that a worker has met: piece -> number, and each number's place among all ids."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.start, self.count, self.n = np.zeros(1024, np.int64), np.zeros(1024, np.int64), 0
        self.ids, self.used = np.zeros(1 << 14, np.uint32), 0

    def add(self, ids: np.ndarray, count: np.ndarray) -> range:
        """New numbers for ids, ``count`` to each."""
        first, more = self.n, len(count)
        while self.n + more > len(self.start):
            self.start, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.count))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.start[first : first + more] = self.used + np.cumsum(count) - count
        self.count[first : first + more] = count
        self.ids[self.used : self.used + len(ids)] = ids
        self.n, self.used = first + more, self.used + len(ids)
        return range(first, first + more)

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(their ids one after another, ids of each)."""
        count = self.count[numbers]
        return self.ids[np.repeat(self.start[numbers] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))], count


def _tokenizer(path: str):
    if _STATE.get("path") != path:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _STATE.clear()
        _STATE.update(path=path, tokenizer=Tokenizer.from_file(path), pieces=Pieces(), old=Pieces())
    return _STATE["tokenizer"]


#: Kinds of bytes: white space, marks, letters and digits that are one byte.
KIND = np.zeros(256, np.uint8)
SPACE, MARK, ALNUM = 1, 2, 4
KIND[list(b" \t\n\v\f\r\x1c\x1d\x1e\x1f")] = SPACE
KIND[list(b",.!?;:&#%*$|")] = MARK
KIND[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = ALNUM


def cuts(raw: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of each piece, texts in which cuts are not safe) for texts that end at ``edge``.

    A byte-level vocabulary never joins characters across the border before a single space, around a
    single line end, or between marks and a letter or digit.
    """
    kind = KIND[raw]
    latin = np.zeros(len(raw), bool)  # second bytes of U+00C0..U+00FF, letters but for two signs
    latin[1:] = (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    kind[latin] = ALNUM
    line = raw == 10
    cut = raw == 32
    cut |= line
    cut[1:] |= line[:-1]
    ahead = kind[1:].copy()
    ahead[raw[1:] == 0xC3] = ALNUM  # also before the two signs: no letters, but what is cut there is a mark
    ahead[:-1][(raw[1:-1] == 0xC3) & ((raw[2:] == 0x97) | (raw[2:] == 0xB7))] = 0
    cut[1:] |= (kind[:-1] | ahead) == MARK | ALNUM
    wide = np.zeros(len(raw), bool)  # white space beyond ASCII
    two, three = np.flatnonzero(raw[:-1] == 0xC2), np.flatnonzero((raw[:-2] >= 0xE1) & (raw[:-2] <= 0xE3))
    wide[two[(raw[two + 1] == 0xA0) | (raw[two + 1] == 0x85)]] = True
    code = raw[three].astype(np.int64) << 16 | raw[three + 1].astype(np.int64) << 8 | raw[three + 2]
    wide[three[(code == 0xE19A80) | (code >= 0xE28080) & (code <= 0xE2808A) | np.isin(code, (0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080))]] = True
    odd = wide
    odd[1:] |= kind[:-1] & kind[1:] & SPACE > 0  # neighbours in two texts make one of them odd, which is harmless
    odd[:-1] |= (raw[:-1] == 60) & (raw[1:] == 124)
    cut[edge[:-1][edge[:-1] < len(raw)]] = True
    return np.flatnonzero(cut), np.unique(np.searchsorted(edge[1:], np.flatnonzero(odd), "right"))


def _numbers(path: str, keys: list[str]) -> np.ndarray:
    """Numbers of different pieces; new ones are encoded."""
    tokenizer = _tokenizer(path)
    if len(_STATE["pieces"].number) > PIECES // 2:
        _STATE["old"], _STATE["pieces"] = _STATE["pieces"], Pieces()
    pieces, old = _STATE["pieces"], _STATE["old"]
    number, before = pieces.number, old.number
    new = [k for k in keys if k not in number]
    back = [k for k in new if k in before]
    number.update(zip(back, pieces.add(*old.of(np.fromiter(map(before.__getitem__, back), np.int64, len(back)))), strict=True))
    new = [k for k in new if k not in number] if back else new
    for at in range(0, len(new), 4096):
        some = new[at : at + 4096]
        found = [e.ids for e in tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        number.update(zip(some, pieces.add(np.fromiter(chain.from_iterable(found), np.uint32, int(count.sum())), count), strict=True))
    return np.fromiter(map(number.__getitem__, keys), np.int64, len(keys))


def token_ids(path: str, texts: pa.Array, end: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, ids of each), ``end`` appended to each text.

    Texts are cut where no token can span (``cuts``), Arrow numbers the pieces, only different ones reach Python, and new ones
    the tokenizer; ids are gathered by number. Texts with neighbouring white space, white space beyond ASCII, or what
    may be a special token, are encoded whole instead. A full memory becomes the old one, from which pieces
    still in use come back.
    """
    tokenizer = _tokenizer(path)
    texts = pa.concat_arrays([texts.cast(pa.string())])
    edge = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[edge[0] : edge[-1]] if data is not None else np.zeros(0, np.uint8)
    edge = edge - edge[0]
    if not len(raw):
        return np.array((end or []) * len(texts), np.uint32), np.full(len(texts), len(end or []), np.int64)
    first, odd = cuts(raw, edge)
    whole = np.zeros(len(texts) + 1, bool)
    whole[odd] = True
    own = np.searchsorted(first, edge)  # first piece of each text
    inside = np.repeat(whole[:-1], np.diff(own))
    words = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(np.append(first, len(raw)).astype(np.int32)), pa.py_buffer(raw)])
    coded = (words.filter(pa.array(~inside)) if len(odd) else words).dictionary_encode()
    codes = np.zeros(len(first), np.int64)
    number = _numbers(path, coded.dictionary.to_pylist())
    pieces = _STATE["pieces"]
    mark = pieces.n, pieces.used
    codes[~inside] = number[coded.indices.to_numpy()]
    if len(odd):
        found = [e.ids for e in tokenizer.encode_batch_fast([texts[k].as_py() for k in odd.tolist()], add_special_tokens=False)]
        codes[inside] = pieces.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))[0]
        codes[own[odd]] = pieces.add(np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64))
    if end:
        codes = np.insert(codes, own[1:], pieces.add(np.array(end, np.uint32), np.array([len(end)]))[0])
        own = own + np.arange(len(own))
    ids, count = pieces.of(codes)
    pieces.n, pieces.used = mark
    before = np.concatenate([[0], np.cumsum(count)])
    return ids, np.diff(before[own])


FILES = "part int, chunk int, start long, n_ids long, doc_ids array<long>, lengths array<int>, file binary"


def write_ids(docs: DataFrame, path: str, parts: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into the table of files at a shared path and read it back.

    ``start`` counts the ids before a file inside its part; parts are ordered by doc_id.
    """
    spark = common.prepare(docs.sparkSession)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        part, chunk, start, held = 0, 0, 0, 0
        keys, sizes, ids = [], [], []

        def close():
            nonlocal chunk, start, held, keys, sizes, ids
            row = [[part], [chunk], [start], [held], [pa.concat_arrays(keys).to_pylist()], [np.concatenate(sizes)], [encode(np.concatenate(ids))]]
            chunk, start, held, keys, sizes, ids = chunk + 1, start + held, 0, [], [], []
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()), strict=True)], names=[x.split()[0] for x in FILES.split(", ")])

        for batch in batches:
            if batch.num_rows:
                part = batch.column(2)[0].as_py()
            found, count = token_ids(path, batch.column(1), [END_ID])
            edge, at = np.concatenate([[0], np.cumsum(count)]), 0
            while at < batch.num_rows:
                # The document that fills the file is its last.
                stop = min(int(np.searchsorted(edge, edge[at] + CHUNK_IDS - held, "left")), batch.num_rows)
                keys.append(batch.column(0).slice(at, stop - at))
                sizes.append(count[at:stop])
                ids.append(found[edge[at] : edge[stop]])
                held, at = held + int(edge[stop] - edge[at]), stop
                if held >= CHUNK_IDS:
                    yield close()
        if keys:
            yield close()

    mark = F.xxhash64("text")  # splits the rows of one id, or of none, over parts
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("h", mark)
    rows = rows.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    return common.stored(rows.withColumn("part", F.spark_partition_id()).mapInArrow(run, FILES), "ids", "none")


def read_ids(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids): each document's ids as uint32 bytes, from the files alone."""
    common.prepare(files.sparkSession)
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row for each part
    before = sizes.select(F.col("part").alias("p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    placed = files.join(F.broadcast(before), files["part"] == before["p"]).select((F.col("before") + F.col("start")).alias("start"), "doc_ids", "lengths", "file")

    def start():
        def step(batch):
            if not batch.num_rows:
                return None
            first, keys, lengths, raw = batch.columns
            values = [decode(x).astype("<u4", copy=False) for x in raw.to_pylist()]
            counts = lengths.flatten().to_numpy().astype(np.int64)
            before = np.cumsum(counts) - counts
            files = np.repeat(np.arange(len(raw)), np.diff(lengths.offsets.to_numpy()))
            begins = np.cumsum([0, *map(len, values)])[:-1]
            edge = pa.py_buffer(np.concatenate([before * 4, [int(counts.sum()) * 4]]).astype(np.int32))
            ids = pa.Array.from_buffers(pa.binary(), len(counts), [None, edge, pa.py_buffer(np.concatenate(values))])
            return [keys.flatten(), first.to_numpy()[files] + before - begins[files], counts, ids]

        return step

    return common.mapped(placed, "doc_id long, start long, n_tokens long, ids binary", start)


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def digest(docs: DataFrame) -> DataFrame:
    return read_ids(write_ids(docs, vocabulary())).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
