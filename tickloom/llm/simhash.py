"""SimHash near-duplicates, searched by pivot distance tables.

A fingerprint's row in the pivot table holds its Hamming distances to
``1 + BLOCKS * MASKS`` reference fingerprints. One reference is random; the
others differ from it inside one block of bits, so that the difference of two
coordinates tells about that block alone. Two fingerprints at most ``RADIUS`` = 2
apart leave at least BLOCKS - 2 blocks untouched, hence agree in all those
blocks' coordinates: fingerprints are dealt out by the coordinates of every
choice of BLOCKS - 2 blocks, and every linked pair meets at least once. Pairs
that meet are discarded when any coordinate differs by over 2 (a distance
to a reference changes by at most the pair's own distance), and the survivors
are verified by their exact distance. No pair is missed and none is false.

Only different fingerprints are dealt out (copies are folded first), and a
meeting place emits a spanning forest of its links, never all pairs. The
blocks not in a key have at most 22 bits, so a place holds at most 2**22 fingerprints of
8 bytes, however skewed the corpus is.

Null and empty texts, and texts of white space, have fingerprint zero; texts of one or two
words have their whole sequence as one shingle. Rows with a null doc_id take
the component of their fingerprint, null if no row with an id shares it.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import common, graph

RADIUS, BLOCKS, MASKS, SHINGLE = 2, 6, 8, 3
#: Places up to this size are compared pair by pair along the sorted rows.
SMALL = 16
BOUNDS = [round(64 * k / BLOCKS) for k in range(BLOCKS + 1)]


def pivots() -> np.ndarray:
    """The reference fingerprints: a random one, then MASKS variants for each block."""
    rng = np.random.default_rng(64)
    base = rng.integers(0, 2**64, dtype=np.uint64)
    found = [base]
    for low, high in zip(BOUNDS, BOUNDS[1:], strict=False):
        for k in range(MASKS):
            mask = rng.integers(1, 2 ** (high - low)) | 1 << k
            found.append(base ^ np.uint64(int(mask) << low))
    return np.array(found, np.uint64)


PIVOTS = pivots()


def coordinates(fps: np.ndarray) -> np.ndarray:
    """Pivot distance table: (fingerprints, pivots) Hamming distances."""
    return np.bitwise_count(fps[:, None] ^ PIVOTS[None]).astype(np.int8)


def place_keys(fps: np.ndarray) -> np.ndarray:
    """(fingerprints, choices) uint64: hashed coordinates of each choice of untouched blocks."""
    table = coordinates(fps)
    own = (table[:, 1:] - table[:, :1]).astype(np.uint8).reshape(len(fps), BLOCKS, MASKS)
    block = common.mix64(np.ascontiguousarray(own).view(np.uint64)[:, :, 0] + np.arange(1, BLOCKS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    keys = []
    for n, choice in enumerate(combinations(range(BLOCKS), BLOCKS - RADIUS)):
        key = np.full(len(fps), n, np.uint64)
        for b in choice:
            key = common.mix64(key * np.uint64(31) + block[:, b])
        keys.append(key)
    return np.stack(keys, 1)


def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs are linked: coordinate filter first, exact distance for survivors."""
    near = np.abs(coordinates(a) - coordinates(b)).max(1, initial=0) <= RADIUS
    near[near] = np.bitwise_count(a[near] ^ b[near]) <= RADIUS
    return near


def forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Index pairs that join the linked fingerprints of one place into trees."""
    order = np.argsort(np.bitwise_count(fps ^ PIVOTS[0]), kind="stable")
    f = fps[order]
    first = np.bitwise_count(f ^ PIVOTS[0]).astype(np.int16)
    some = coordinates(f)[:, :: MASKS // 2]
    root = np.arange(len(f))
    edges = []

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    step = max(1, (1 << 22) // max(1, len(f)))
    for at in range(0, len(f), step):
        mine = np.arange(at, min(at + step, len(f)))
        stop = np.searchsorted(first, first[mine[-1]] + RADIUS, "right")
        others = np.arange(at, stop)
        near = np.ones((len(mine), len(others)), bool)
        for k in range(some.shape[1]):  # maximum coordinate difference, coordinate by coordinate
            near &= np.abs(some[mine, k][:, None] - some[others, k][None]) <= RADIUS
        i, j = np.nonzero(near)
        i, j = mine[i], others[j]
        keep = (i < j) & (np.bitwise_count(f[i] ^ f[j]) <= RADIUS)
        i, j = i[keep], j[keep]
        while len(i):
            tops = np.array([find(x) for x in np.unique(np.concatenate([i, j]))])
            names = np.unique(np.concatenate([i, j]))
            a, b = tops[np.searchsorted(names, i)], tops[np.searchsorted(names, j)]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            if not len(i):
                break
            _, one = np.unique(np.minimum(a, b) * len(f) + np.maximum(a, b), return_index=True)
            for k in one:
                x, y = find(i[k]), find(j[k])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    edges.append((int(order[i[k]]), int(order[j[k]])))
            break
    return edges


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    words = common.lower_words(raw)
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        h = np.array([hashed(text[s:e], 42) for s, e in zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)], strict=True)], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the 64-bit fingerprint as a signed long."""
    common.prepare(docs.sparkSession)

    def start():
        def step(batch):
            fps = np.array([fingerprint(x, shingle) for x in batch.column(1).to_pylist()], np.uint64)
            return [batch.column(0), pa.array(fps.view(np.int64))]

        return step

    return common.mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.body(F.col("text")).alias("b")), "doc_id long, fp long", start)


def links(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) over the reps of different fingerprints (fp, rep), enough to connect all that are linked."""
    def deal():
        def step(batch):
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            keys = place_keys(fps)
            n = keys.shape[1]
            return [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(fps.view(np.int64), n)), pa.array(np.repeat(batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64), n))]

        return step

    dealt = common.mapped(nodes, "key long, fp long, rep long", deal).repartition("key").sortWithinPartitions("key")

    def meet(batches):
        held = [np.zeros(0, np.int64)] * 3

        def joined(key, fps, reps):
            a, b = [], []
            change = np.flatnonzero(np.diff(key)) + 1
            starts, ends = np.concatenate([[0], change]), np.concatenate([change, [len(key)]])
            sizes = ends - starts
            big = sizes > SMALL
            small = ~np.repeat(big, sizes)
            for s in range(1, SMALL):
                i = np.flatnonzero((key[s:] == key[:-s]) & small[s:])
                if not len(i):
                    break
                ok = close(fps[i], fps[i + s])
                a.append(reps[i[ok]])
                b.append(reps[i[ok] + s])
            for x, y in zip(starts[big], ends[big], strict=True):
                pairs = np.array(forest(fps[x:y]), np.int64).reshape(-1, 2) + x
                a.append(reps[pairs[:, 0]])
                b.append(reps[pairs[:, 1]])
            return a, b

        def out(key, fps, reps):
            a, b = joined(key, fps.view(np.uint64), reps) if len(key) else ([], [])
            for x, y in zip(a, b, strict=True):
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

        for batch in batches:
            got = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns, strict=True)]
            if not len(got[0]):
                continue
            cut = np.searchsorted(got[0], got[0][-1])  # the last place may go on
            yield from out(*(x[:cut] for x in got))
            held = [x[cut:] for x in got]
        yield from out(*held)

    return dealt.mapInArrow(meet, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text)."""
    prints = common.stored(fingerprints(docs, shingle), "fingerprints")
    reps = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    found = graph.components(links(reps.where("rep is not null")))
    known = reps.join(found, reps["rep"] == found["node"], "left").select(F.col("fp").alias("own"), F.coalesce("component", "rep").alias("component_id"))
    return prints.join(known, prints["fp"] == known["own"]).select("doc_id", "fp", "component_id")


# Similarity of 0.8 on five-word shingles, for the filtering stage. Texts that similar may differ in
# a dozen bits of a whole-text fingerprint, so texts get fingerprints of small shingle samples as well.
BANDS, SAMPLE, BINS = 12, 3, 512
# A sketch's standard error is 0.02 at most with FEW bins in use or more: estimates from MAYBE to SURE
# are decided on the shingle sets, with fewer bins all from MAYBE_FEW.
SURE, MAYBE, MAYBE_FEW, FEW = 0.9, 0.7, 0.5, 128
_SALT = np.random.default_rng(12).integers(1, 2**64, (BANDS + 1, 1), dtype=np.uint64)


def shingle_hashes(raw: bytes, shingle: int) -> np.ndarray:
    """Different shingle hashes of a text, ascending."""
    words = common.lower_words(raw)
    if not words:
        return np.zeros(0, np.uint64)
    text, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(text[s:e], 42) for s, e in zip(starts, stops, strict=True)), np.uint64, n))


def band_places(h: np.ndarray) -> np.ndarray:
    """One place for each band: the SimHash of the band's SAMPLE least shingles, by its pivot coordinates."""
    if not len(h):
        return np.zeros(0, np.uint64)
    mixed = common.mix64(h[None] ^ _SALT[:BANDS])
    if len(h) > SAMPLE:
        some = h[np.argpartition(mixed, SAMPLE - 1, axis=1)[:, :SAMPLE]]
    else:
        some = np.broadcast_to(h, (BANDS, len(h)))
    bits = np.unpackbits(np.ascontiguousarray(some).view(np.uint8).reshape(BANDS, -1, 8), axis=2, bitorder="little").sum(1)
    fps = np.packbits(bits * 2 > some.shape[1], axis=1, bitorder="little").view(np.uint64)[:, 0]
    table = np.concatenate([coordinates(fps).view(np.uint8), np.zeros((BANDS, -(1 + BLOCKS * MASKS) % 8), np.uint8)], 1).view(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(table.shape[1]):
        key = common.mix64(key * np.uint64(31) + table[:, k])
    return key


def sketch(h: np.ndarray) -> bytes:
    """The least shingle of each of BINS bins, one byte each; 0 is an empty bin."""
    out = np.zeros(BINS, np.uint8)
    x = common.mix64(h ^ _SALT[BANDS])
    x = x[np.argsort(x >> np.uint64(9))[::-1]]
    out[(x & np.uint64(BINS - 1)).astype(np.int64)] = 1 + (x >> np.uint64(9)) % np.uint64(255)
    return out.tobytes()


def estimates(s: np.ndarray, x: int, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(equal bins, bins in use) of the sketch x and each of some."""
    equal, used = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)
    for at in range(0, len(some), 4096):
        them = s[some[at : at + 4096]]
        # Bins counted eight columns at a time: a byte holds at most BINS / 8 ones.
        count = lambda y: y.view(np.uint64).sum(1).view(np.uint8).reshape(-1, 8).sum(1, dtype=np.int64)
        empty = count((them | s[x]) == 0)  # bins that both leave empty are equal, but not alike
        equal[at : at + 4096], used[at : at + 4096] = count(them == s[x]) - empty, BINS - empty
    return equal, used


def judged(s: np.ndarray, x: int, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of some are surely linked to x, and which may be: estimates near 0.8, by a wider margin where few bins are in use."""
    equal, used = estimates(s, x, some)
    sure = (equal >= SURE * used) & (used >= FEW)
    return sure, ~sure & (equal >= np.where(used >= FEW, MAYBE, MAYBE_FEW) * used)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Exactly: shingle sets of similarity 0.8 or more."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * 5 >= 4 * (len(a) + len(b) - both)


def alike_forest(s: np.ndarray, sets: list[np.ndarray] | None = None) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Tree edges of the texts of one place, and the texts whose links need their shingle sets.

    Without sets, a tree that is held by sure links is returned; of one that needs links that may
    be, all texts are. With sets, those links are decided exactly and no text is left.
    """
    left, edges, unsettled = np.arange(len(s)), [], []
    while len(left):
        todo, left, unsure = [int(left[0])], left[1:], False
        tree, members = [], list(todo)
        while todo and len(left):
            x = todo.pop()
            near, may = judged(s, x, left)
            if sets is not None:
                near[may] = [similar(sets[x], sets[y]) for y in left[may]]
            else:
                unsure |= bool(may.any())
                near |= may
            found, left = left[near].tolist(), left[~near]
            tree += [(x, y) for y in found]
            todo += found
            members += found
        if unsure:
            unsettled += members
        else:
            edges += tree
    return edges, np.array(sorted(unsettled), np.int64)


def met(dealt: DataFrame, shingle: int | None = None) -> DataFrame:
    """(place, a, b) of the texts (key, rep, sketch) that meet: tree edges have no place; a text a whose
    links need shingles has the number of its place, one for all places with the same such texts.
    With ``shingle``, texts stand for sketches and every link is decided."""

    def out(key, reps, what):
        change = np.flatnonzero(np.diff(key)) + 1
        places_, a, b = [], [], []
        for x, y in zip([0, *change.tolist()], [*change.tolist(), len(key)], strict=True):
            rep, order = np.unique(reps[x:y], return_index=True)
            here = [what[x + k] for k in order.tolist()]
            sets = [shingle_hashes(t, shingle) for t in here] if shingle else None
            sketches = b"".join(map(sketch, sets) if shingle else here)
            edges, left = alike_forest(np.frombuffer(sketches, np.uint8).reshape(-1, BINS), sets)
            place = xxhash.xxh3_64_intdigest(rep[left].tobytes()) >> 1
            places_ += [None] * len(edges) + [place] * len(left)
            a += [int(rep[i]) for i, _ in edges] + rep[left].tolist()
            b += [int(rep[j]) for _, j in edges] + [None] * len(left)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (places_, a, b)], names=["place", "a", "b"])

    def meet(batches):
        key, reps, what = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        for batch in batches:
            key, reps = (np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip((key, reps), batch.columns, strict=False))
            what += batch.column(2).to_pylist()
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))  # the last place may go on
            if cut:
                yield out(key[:cut], reps[:cut], what[:cut])
            key, reps, what = key[cut:], reps[cut:], what[cut:]
        if len(key):
            yield out(key, reps, what)

    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "place long, a long, b long")


def grouped(docs: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, mark, same), ``mark`` a hash of id and text, and what is known of texts: (same, component, keep): the
    least id of the group, and whether the group's kept document has this text.

    Equal word sequences are folded first. Texts meet where a band's fingerprint has equal pivot
    coordinates (pairs with any coordinate difference are discarded). Two texts of similarity 0.8
    meet in at least one band but for about 2 in 10,000 pairs. Sketches decide pairs
    well over or under 0.8; places with others meet a second time, those texts only, and
    are decided exactly on their shingle sets. A place emits a spanning forest. Texts without words are equal to each other.
    """
    common.prepare(docs.sparkSession)

    def start():
        def step(batch):
            same, nodes, places_, sketches = [], [], [], []
            for raw in batch.column(2).to_pylist():
                h = shingle_hashes(raw, shingle)
                name = xxhash.xxh3_128_digest(b" ".join(common.lower_words(raw)))
                same.append(name)
                nodes.append(int.from_bytes(name[:8], "little", signed=True))
                places_.append(band_places(h).view(np.int64).tolist())
                sketches.append(sketch(h))
            return [batch.column(0), batch.column(1), same, nodes, places_, sketches]

        return step

    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("mark"), common.body(F.col("text")).alias("b"))
    prints = common.stored(common.mapped(rows, "doc_id long, mark long, same binary, rep long, places array<long>, sketch binary", start), "sketches")
    reps = prints.groupBy("same").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("most"))
    # A text's first document stands for it; a row that is there twice is taken once.
    first = prints.join(reps.select("same", "doc_id"), ["same", "doc_id"], "left_semi").dropDuplicates(["same", "doc_id"])
    placed = first.select(F.explode("places").alias("key"), "rep")
    shared = placed.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z").select(F.col("key").alias("k"))
    some = placed.join(shared, F.col("key") == F.col("k"), "left_semi")
    dealt = some.join(first.select(F.col("rep").alias("r"), "sketch"), F.col("rep") == F.col("r")).select("key", "rep", "sketch")

    edges = common.stored(met(dealt), "links")
    # Places with the same such texts, as the bands of one group often have, meet once.
    unsure = edges.where("place is not null").select("place", F.col("a").alias("rep")).distinct()
    named = unsure.join(first.select("rep", "doc_id", "mark"), "rep")
    texts = rows.join(named, ["doc_id", "mark"]).select(F.col("place").alias("key"), "rep", "b")
    again = met(texts, shingle)
    found = common.stored(graph.components(edges.where("place is null").select("a", "b").unionByName(again.select("a", "b"))), "components")
    members = found.select(F.col("node").alias("rep"), "component").join(first.select("rep", "same", "doc_id"), "rep")
    best = members.groupBy("component").agg(F.min("doc_id").alias("least"))
    with_least = common.told_each(members, best, "component", "rep")
    kept = with_least.where("doc_id = least").groupBy("component").agg(F.min("rep").alias("kept"))
    linked = common.told_each(with_least, kept, "component", "rep").select("same", "least", (F.col("rep") == F.col("kept")).alias("keep"))
    # Texts that are neither linked nor there twice need no word.
    told = reps.join(linked, "same", "left").where("least is not null or most > doc_id").select("same", F.coalesce("least", "doc_id").alias("component"), F.coalesce("keep", F.lit(True)).alias("keep"))
    return prints.select("doc_id", "mark", "same"), told


def alike(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """(doc_id, component_id) of every row with an id: groups of texts of similarity 0.8 or more; rows of
    one id are grouped each by its own text."""
    rows, told = grouped(docs, shingle)
    return common.told_each(rows, told, "same", "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """``docs`` with the document of least id of each group of similar documents; columns unchanged.

    Rows with a null id stay; a kept row that is there twice stays twice. Of several texts of the least id one is kept.
    """
    rows, told = grouped(docs, shingle)
    gone = common.told_each(rows, told, "same", "doc_id").where("not keep or doc_id <> component").select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).distinct()
    return docs.join(gone, (docs["doc_id"].cast("long") == gone["__id"]) & (F.xxhash64(docs["doc_id"], docs["text"]) == gone["__mark"]), "left_anti")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
