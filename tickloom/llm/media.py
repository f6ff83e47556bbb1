"""Telephony audio columns: mu-law, A-law and IMA ADPCM in, linear PCM out.

The two companding laws are expanded by 256-entry lookup tables; ADPCM, whose
samples depend on each other only inside one block, is decoded with numpy
across all blocks at once (one step for each sample position).

Results in odd cases: null or unreadable media give null columns, and so do files of another
law, of more than one channel, of another sample width, with a rate of zero or ADPCM blocks too short for a
header and a sample; an empty data chunk gives zero samples; a last ADPCM block that is cut short is dropped
as the format demands whole blocks.

The query keeps each text's bytes as the samples of one of the three formats, which a hash of the
bytes chooses. ADPCM blocks of all files of a batch are decoded together.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import common

PCM, ALAW, ULAW, ADPCM = 1, 6, 7, 17
#: Bits of a sample that are read.
WIDTHS = {PCM: 16, ALAW: 8, ULAW: 8, ADPCM: 4}
#: The payload of the query is padded to whole units of this many bytes.
UNIT = 576
#: Bytes of the query's ADPCM blocks; whole blocks fill a unit.
BLOCK = 72

# Fixed values of the IMA ADPCM format: index steps and quantiser steps.
INDEX_STEPS = [-1, -1, -1, -1, 2, 4, 6, 8]
QUANTISER = [
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
    130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060,
    1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484,
    7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
]


def ulaw_table() -> np.ndarray:
    code = ~np.arange(256) & 0xFF
    size = ((((code & 0x0F) << 3) + 0x84) << ((code & 0x70) >> 4)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    code = np.arange(256) ^ 0x55
    step, low = (code & 0x70) >> 4, (code & 0x0F) << 4
    size = np.where(step == 0, low + 8, (low + 0x108) << np.maximum(step - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


TABLES = {ULAW: ulaw_table(), ALAW: alaw_table()}


def decode_adpcm(data: bytes, block: int) -> np.ndarray:
    """Mono IMA ADPCM: all blocks advance together, one nibble at a time."""
    blocks = np.frombuffer(data, np.uint8)[: len(data) // block * block].reshape(-1, block)
    if not len(blocks):
        return np.zeros(0, np.int16)
    steps, moves = np.array(QUANTISER, np.int32), np.array(INDEX_STEPS * 2, np.int32)
    value = np.ascontiguousarray(blocks[:, :2]).view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2].astype(np.int32), len(QUANTISER) - 1)
    nibbles = np.empty(((block - 4) * 2, len(blocks)), np.int32)
    nibbles[0::2], nibbles[1::2] = (blocks[:, 4:] & 15).T, (blocks[:, 4:] >> 4).T
    out = np.empty((len(nibbles) + 1, len(blocks)), np.int16)
    out[0] = value
    for k, code in enumerate(nibbles, 1):
        step = steps[index]
        change = (step >> 3) + (step >> 2) * (code & 1) + (step >> 1) * (code >> 1 & 1) + step * (code >> 2 & 1)
        value = np.clip(np.where(code & 8, value - change, value + change), -32768, 32767)
        index = np.clip(index + moves[code], 0, len(QUANTISER) - 1)
        out[k] = value
    return out.T.ravel()


def wav(data: bytes, law: int, rate: int = 8000, block: int = 1) -> bytes:
    """A RIFF file around ``data``: PCM16, A-law, mu-law or IMA ADPCM, mono."""
    bits = WIDTHS[law]
    align = {PCM: 2, ALAW: 1, ULAW: 1, ADPCM: block}[law]
    extra = struct.pack("<HH", 2, (block - 4) * 2 + 1) if law == ADPCM else b"" if law == PCM else struct.pack("<H", 0)
    speed = rate * align if law != ADPCM else rate * block // ((block - 4) * 2 + 1)
    fmt = struct.pack("<HHIIHH", law, 1, rate, speed, align, bits) + extra
    chunks = b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)
    return b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks


def parse_wav(raw: bytes | None) -> tuple[int, int, int, bytes] | None:
    """(law, rate, block, data) of a file written by any writer, or None."""
    if raw is None or len(raw) < 12 or raw[:4] != b"RIFF" or raw[8:12] != b"WAVE":
        return None
    at, fmt = 12, None
    while at + 8 <= len(raw):
        kind, size = raw[at : at + 4], struct.unpack_from("<I", raw, at + 4)[0]
        if kind == b"fmt " and size >= 16:
            if at + 24 > len(raw):
                return None
            fmt = struct.unpack_from("<HHIIHH", raw, at + 8)
            law, channels, rate, _, block, bits = fmt
            if channels != 1 or not rate or WIDTHS.get(law) != bits or (law == ADPCM and block <= 4):
                return None
        elif kind == b"data" and fmt:
            return fmt[0], fmt[2], fmt[4], raw[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    return None


def to_pcm(files: list[tuple[int, int, int, bytes] | None]) -> list[np.ndarray | None]:
    """Samples of each parsed file; the ADPCM blocks of one length are decoded together."""
    out: list[np.ndarray | None] = [None] * len(files)
    blocks: dict[int, list[int]] = {}
    for k, parsed in enumerate(files):
        if parsed is None:
            continue
        law, _, block, data = parsed
        if law in TABLES:
            out[k] = TABLES[law][np.frombuffer(data, np.uint8)]
        elif law == ADPCM:
            blocks.setdefault(block, []).append(k)
        else:
            out[k] = np.frombuffer(data[: len(data) // 2 * 2], "<i2")
    for block, some in blocks.items():
        count = [len(files[k][3]) // block for k in some]
        samples = decode_adpcm(b"".join(files[k][3][: n * block] for k, n in zip(some, count, strict=True)), block)
        edges = np.cumsum(count)[:-1] * ((block - 4) * 2 + 1)
        for k, pcm in zip(some, np.split(samples, edges), strict=True):
            out[k] = pcm
    return out


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation between the two nearest samples, in exact integers, rounded down."""
    if rate == to or not len(pcm):
        return pcm.astype(np.int16)
    n = (len(pcm) * to) // rate
    if to == 2 * rate:  # the usual step from 8 to 16 kHz
        out = np.empty(n, np.int16)
        out[0::2] = pcm
        out[1:-1:2] = (pcm[:-1].astype(np.int32) + pcm[1:]) >> 1
        out[-1] = pcm[-1]
        return out
    at, part = np.divmod(np.arange(n, dtype=np.int64) * rate, to)
    nxt = np.minimum(at + 1, len(pcm) - 1)
    return ((pcm[at] * (to - part) + pcm[nxt] * part) // to).astype(np.int16)


def decoded(df: DataFrame, media: str = "media", rate: int = 16000, key: str = "doc_id") -> DataFrame:
    """(key, rate, pcm): little-endian PCM16 at ``rate`` for each row's media file."""
    common.prepare(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def start():
        def step(batch):
            parsed = [parse_wav(x) for x in batch.column(1).to_pylist()]
            pcm = [None if p is None else resample(x, p[1], rate).astype("<i2").tobytes() for p, x in zip(parsed, to_pcm(parsed), strict=True)]
            return [batch.column(0), [None if p is None else rate for p in parsed], pcm]

        return step

    return common.mapped(df.select(F.col(key), F.col(media)), f"{key} {kind}, rate int, pcm binary", start)


def store_pcm(df: DataFrame, path: str, **options) -> None:
    """Write the decoded, resampled PCM as a Parquet media table."""
    decoded(df, **options).write.option("compression", "zstd").parquet(path)


def store_texts(docs: DataFrame) -> DataFrame:
    """Each text's padded bytes as the mu-law, A-law or ADPCM samples of a WAV file, in a shared table."""
    common.prepare(docs.sparkSession)

    def start():
        def step(batch):
            raw = batch.column(1).to_pylist()
            padded = (x + b"\xff" * (max(1, -(-len(x) // UNIT)) * UNIT - len(x)) for x in raw)
            files = (wav(x, (ULAW, ALAW, ADPCM)[zlib.crc32(x) % 3], block=BLOCK) for x in padded)
            return [batch.column(0), [len(x) for x in raw], list(files)]

        return step

    made = common.mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.body(F.col("text")).alias("b")), "doc_id long, n_bytes long, media binary", start)
    return common.stored(made, "media")


def describe(media: DataFrame, rate: int = 16000) -> DataFrame:
    """Digests of the stored files as read back, and features of the PCM at ``rate``.

    feature: samples, peak, mean square, zero crossings and crc32 of the resampled PCM.
    """

    def start():
        def step(batch):
            rows, files = [], batch.column(2).to_pylist()
            parsed = [parse_wav(raw) for raw in files]
            for raw, (_, own, _, data), samples in zip(files, parsed, to_pcm(parsed), strict=True):
                pcm = resample(samples, own, rate)
                wide = pcm.astype(np.int64)
                peak, power = int(np.abs(wide).max()), int(np.dot(wide, wide)) // len(pcm)
                crossings = int(np.count_nonzero((pcm[1:] < 0) != (pcm[:-1] < 0)))
                feature = f"{len(pcm)}:{peak}:{power}:{crossings}:{zlib.crc32(pcm.astype('<i2').tobytes())}"
                rows.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]), len(raw), hashlib.sha256(raw).hexdigest(), feature))
            return [batch.column(0), batch.column(1), *(list(x) for x in zip(*rows, strict=True))] if rows else None

        return step

    return common.mapped(media, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", start)


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe(store_texts(spark.read.parquet(f"{sf_dir}/documents.parquet")))
