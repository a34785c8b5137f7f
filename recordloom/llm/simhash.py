"""SimHash near-duplicates: fingerprints of shingles, linked by bit-sliced comparison.

Two fingerprints within the radius agree on two whole quarters at least, so all fingerprints that
share a pair of quarters meet in a bucket. Inside a bucket the fingerprints stand as bit planes
(word b holds bit b of 64 fingerprints); a probe is compared with all of them at once by XOR and
carry-save counters, and leaves as soon as every lane has passed the radius. Only a spanning forest
of a bucket's links goes on, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, map_texts, written
from .components import components

SEED, SHINGLE, RADIUS = 42, 3, 2
#: Fingerprints of a bucket that one task compares with as many others; larger buckets are cut into such blocks.
BLOCK = 1024
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text's word shingles; zero if it has no words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    parts = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in parts), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 255):
        counts += np.add.reduce(np.unpackbits(hashes[at : at + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t) for t in batch.column(1).cast(pa.binary()).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t) for t in batch.column(1).cast(pa.binary()).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["row", "fp"])


def _struct(df: DataFrame) -> str:
    return df.select(F.struct(*df.columns).alias("row")).schema["row"].dataType.simpleString()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): fp is the 64-bit fingerprint as a signed long."""
    return map_texts(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), _fingerprints, "id long, fp long")


def near(probes: np.ndarray, lanes: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Matrix (probes, words) of 64-lane masks: which lanes are within radius of each probe. Both are uint64 arrays.

    lanes may be (words, 64) for all probes, or (probes, words, 64) for lanes of each probe's own.
    """
    planes = sliced(lanes)
    if planes.ndim == 2:
        planes = np.broadcast_to(planes[:, None, :], (64, len(probes), planes.shape[1]))
    found = np.zeros(planes.shape[1:], np.uint64)
    alive = np.arange(len(probes))
    bits = (radius + 1).bit_length()
    counters = [np.zeros_like(found) for _ in range(bits)]
    over = np.zeros_like(found)
    for b in range(64):
        flip = (np.uint64(0) - ((probes[alive] >> np.uint64(b)) & np.uint64(1)))[:, None]
        carry = planes[b][alive] ^ flip
        for counter in counters:
            carry, counter[:] = counter & carry, counter ^ carry
        over |= carry
        if b % 8 == 7:
            past = _past(counters, over, radius)
            left = ~np.all(past == ONES, axis=1)  # the rest is abandoned
            if not left.all():
                alive, over, counters = alive[left], over[left], [c[left] for c in counters]
                if not len(alive):
                    return found
    found[alive] = ~_past(counters, over, radius)
    return found


def _past(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count exceeds radius: compared bit by bit, from the highest."""
    more, same = over.copy(), ~over
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            same &= counters[k]
        else:
            more |= same & counters[k]
            same &= ~counters[k]
    return more


def sliced(lanes: np.ndarray) -> np.ndarray:
    """(…, 64) fingerprints to (64, …) planes: bit i of plane b is bit b of fingerprint i."""
    flat = np.ascontiguousarray(lanes).reshape(-1, 64)
    bits = np.unpackbits(flat.view(np.uint8).reshape(len(flat), 64, 8), axis=2, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.transpose(0, 2, 1)), axis=2, bitorder="little").view(np.uint64)[:, :, 0]
    return np.ascontiguousarray(packed.T).reshape(64, *lanes.shape[:-1])


def _forest(masks: list[int]) -> list[int]:
    """Merge overlapping bit sets."""
    sets: list[int] = []
    for m in masks:
        apart = []
        for s in sets:
            if s & m:
                m |= s
            else:
                apart.append(s)
        sets = [*apart, m]
    return sets


def _edges(masks: list[int], members: np.ndarray) -> list[tuple[int, int]]:
    out = []
    for s in _forest(masks):
        least = None
        while s:
            low = s & -s
            node = int(members[low.bit_length() - 1])
            if least is not None:
                out.append((node, least))
            least = node if least is None else least
            s ^= low
    return out


def _small(groups: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links inside buckets of up to 64 members, a lane word each, all buckets at once."""
    groups = sorted(groups, key=len, reverse=True)
    sizes = np.array([len(g) for g in groups])
    lanes = np.zeros((len(groups), 64), np.uint64)
    for i, g in enumerate(groups):
        lanes[i, : len(g)] = g
    valid = np.array([(1 << n) - 1 for n in sizes], np.uint64)
    masks: list[list[int]] = [[] for _ in groups]
    for s in range(int(sizes[0])):
        n = int(np.searchsorted(-sizes, -s, "left"))  # buckets with more than s members
        hit = near(lanes[:n, s], lanes[:n, None, :])[:, 0] & valid[:n]
        for i in np.flatnonzero(hit & (hit - np.uint64(1))):
            masks[i].append(int(hit[i]))
    return [e for m, g in zip(masks, groups, strict=True) if m for e in _edges(m, g)]


def _large(lanes: np.ndarray, probes: np.ndarray) -> list[tuple[int, int]]:
    """Links between a block of lanes and a block of probes (the same block, or two of one bucket)."""
    n = len(lanes)
    padded = np.zeros(-(-n // 64) * 64, np.uint64)
    padded[:n] = lanes
    hit = near(probes, padded.reshape(-1, 64))
    whole, masks = (1 << n) - 1, []
    for i in np.flatnonzero(hit.any(axis=1)):
        m = int.from_bytes(hit[i].tobytes(), "little") & whole
        if m:
            masks.append(m | 1 << (n + int(i)))
    return _edges(masks, np.concatenate([lanes, probes]))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k, i, j, side, fp) sorted by (k, i, j) to a spanning forest of each bucket's links."""

    def out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        both = np.array([p for p in pairs if p[0] != p[1]], np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["u", "v"])

    small: list[np.ndarray] = []
    held = 0

    def closed(rows: np.ndarray) -> list[tuple[int, int]]:
        nonlocal held, small
        fps, i, j, side = rows[:, 4].view(np.uint64), rows[0, 1], rows[0, 2], rows[:, 3]
        if i == j and len(fps) <= 64:
            small.append(fps)
            held += 64
            if held >= 1 << 20:
                done, small, held = _small(small), [], 0
                return done
            return []
        lanes, probes = (fps, fps) if i == j else (fps[side == i], fps[side == j])
        found = []
        for at in range(0, len(lanes), 4 * BLOCK):  # blocks are of BLOCK rows on average
            for of in range(0, len(probes), 4 * BLOCK):
                found += _large(lanes[at : at + 4 * BLOCK], probes[of : of + 4 * BLOCK])
        return found

    rest = np.zeros((0, 5), np.int64)
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy() for c in range(5)], axis=1)
        rows = np.concatenate([rest, rows])
        cuts = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        at = 0
        for cut in cuts:
            if found := closed(rows[at:cut]):
                yield out(found)
            at = cut
        rest = rows[at:].copy()
    if len(rest) and (found := closed(rest)):
        yield out(found)
    if small:
        yield out(_small(small))


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (fp) to edges (u, v) that connect all those within radius: a spanning forest, bucket by bucket."""
    if radius > 2:
        raise ValueError("quarters find every pair up to radius 2")
    quarters = [F.shiftrightunsigned("fp", 16 * q).bitwiseAND(0xFFFF) for q in range(4)]
    keys = F.array(*(F.shiftleft(F.lit(t).cast("long"), 32) + F.shiftleft(quarters[a], 16) + quarters[b] for t, (a, b) in enumerate(combinations(range(4), 2))))
    rows = fps.select("fp", F.explode(keys).alias("k"))
    sizes = rows.groupBy("k").count().where("count > 1")
    rows = rows.join(sizes, "k").withColumn("blocks", F.ceil(F.col("count") / block).cast("int"))
    rows = rows.withColumn("side", F.pmod(F.xxhash64("fp", "k"), F.col("blocks")).cast("long"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1))
    rows = rows.select("k", "side", "fp", other.alias("other")).select("k", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "fp")
    rows = rows.repartition("k", "i", "j").sortWithinPartitions("k", "i", "j")
    return rows.mapInArrow(lean(_compare), "u long, v long")


def rooted(marked: DataFrame) -> DataFrame:
    """(fp, rep, root) of each distinct fingerprint of (id, fp): its least id, null if it has none, and the fingerprint that names its component."""
    reps = marked.groupBy("fp").agg(F.min("id").alias("rep"))
    linked = components(links(reps.select("fp")))
    return reps.join(linked, reps["fp"] == linked["node"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: (id_col, fingerprint, component_id).

    fingerprint: 16 hex digits. component_id: the least id that links of at most RADIUS differing bits
    reach, the row's own included. Null and empty texts have fingerprint zero and link like any other.
    Rows with a null id get a fingerprint and link others, but no id names them: their component_id is
    null if no row of it has an id. Repeated rows give repeated results; an empty table gives none.
    Other columns of docs are not looked at.
    """
    marked = written(fingerprints(docs, id_col, text_col), "fingerprints")
    reps = rooted(marked)
    least = reps.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = reps.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without near-duplicates: of each component the row with the least id stays.

    Rows that repeat that id stay with it, and rows without an id stay: no id says which of them to drop.
    """
    kept = near_duplicates(docs, id_col, text_col).where(F.col(id_col).isNull() | (F.col("component_id") == F.col(id_col)))
    keys = kept.select(F.col(id_col).alias("__kept")).distinct()
    return docs.join(keys, docs[id_col].eqNullSafe(keys["__kept"]), "left_semi")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly one row of docs of each component, whatever its ids: the row with the least id, or one without an id if none has one.

    Of rows that share that id (or the lack of one), the least fingerprint and then the least text stays.
    Components of rows without an id are told apart by their fingerprints. Other columns are not looked at.
    """
    marked = written(fingerprints(docs, id_col, text_col), "fingerprints")
    first = rooted(marked).groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("unnamed"), F.col("rep").alias("id"), "fp")).alias("first"))
    stays = first.select(F.col("first.id").alias("id"), F.col("first.fp").alias("fp"))
    rows = marked.groupBy("id").count()
    stays = written(stays.join(rows, stays["id"].eqNullSafe(rows["id"]), "left").select(stays["id"], "fp", ((F.col("count") == 1) & stays["id"].isNotNull()).alias("alone")), "stays")
    key = F.col(id_col).cast("long")
    # An id of one row names it. Of the few others the text tells which component they are of.
    alone = docs.join(stays.where("alone").select(F.col("id").alias("__kept")), key == F.col("__kept"), "left_semi")
    shared = stays.where("not alone")
    ids = shared.select(F.col("id").alias("__kept")).distinct()
    rest = docs.join(ids, key.eqNullSafe(F.col("__kept")), "left_semi")
    marks = map_texts(rest.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text")), _marks, f"row {_struct(docs)}, fp long")
    marks = marks.withColumn("id", F.col("row")[id_col].cast("long")).groupBy("id", "fp").agg(F.min_by("row", F.struct(F.col("row")[text_col])).alias("row"))
    one = marks.join(shared.select(F.col("id").alias("__kept"), F.col("fp").alias("__fp")), F.col("id").eqNullSafe(F.col("__kept")) & (F.col("fp") == F.col("__fp")), "left_semi")
    return alone.unionByName(one.select("row.*"))
