"""Removal of long passages that repeat anywhere in a corpus, by two-stage suffix sorting of shards.

Every 200-byte window is given to the one of its 32-byte strings with the least hash, its anchor;
equal windows have equal anchors at equal places. The windows of one anchor in one document are a
region, a stretch of text a little longer than a window. Only regions whose anchor occurs twice or
more can hold repeats. Byte-identical regions collapse to one text with a count; the texts are dealt
to shards by anchor (those of a frequent anchor by pairs of blocks), so that equal windows meet, and a
shard finds them with a suffix array and adjacent common prefixes. What a region learns goes back to its documents, which drop covered bytes.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, lean, slices, utf8, written
from .suffixes import DEPTH, repeated

ANCHOR = 32
#: Text that a shard sorts at once; a document's windows that are hashed at once. Either needs some 60 times as much memory.
SHARD_BYTES, STRETCH = 2 << 20, 1 << 20
#: Distinct regions of an anchor that are sorted together; a larger anchor's are cut into such blocks, which meet pairwise.
BLOCK = 1024
#: Distinct regions of one anchor beyond which its windows are dealt out one by one: pairs of blocks grow with their square.
HOT = 40_000
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15)]
_PLACE = np.uint64((1 << 24) - 1)


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(anchor hash, first window) of each region of a text of up to STRETCH windows; the windows run to the next one's first."""
    n = len(raw)
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = np.frombuffer(raw, np.uint8)
    w = np.empty((n + 8) // 8 * 8, np.uint64)
    for s in range(8):
        w[s::8] = padded[s : s + (n + 8) // 8 * 8].view(np.uint64)
    g = n - ANCHOR + 1
    h = np.zeros(g, np.uint64)
    for k in range(ANCHOR // 8):
        h ^= w[8 * k : 8 * k + g] * _C[k]
        h = (h ^ (h >> np.uint64(29))) * _C[k + 1]
    h ^= h >> np.uint64(32)
    key = (h & ~_PLACE) | np.arange(g, dtype=np.uint64)  # ties go to the first place
    span = DEPTH - ANCHOR + 1
    blocks = np.full(-(-g // span) * span, ~np.uint64(0))
    blocks[:g] = key
    blocks = blocks.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    windows = n - DEPTH + 1
    place = (np.minimum(ahead[:windows], behind[span - 1 : span - 1 + windows]) & _PLACE).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    return h[place[first]], first


def regions_of(raw: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor hash, digest of the region's text, first byte, bytes) of the regions of a whole text."""
    for at in range(0, len(raw) - DEPTH + 1, STRETCH):
        part = raw[at : at + STRETCH + DEPTH - 1]
        h, first = anchors(part)
        size = np.concatenate([first[1:], [len(part) - DEPTH + 1]]) - first + DEPTH - 1
        digest = np.fromiter((xxhash.xxh3_64_intdigest(part[a : a + n]) for a, n in zip(first.tolist(), size.tolist(), strict=True)), np.uint64, len(first))
        yield h, digest, first + at, size


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2):
        found: list[list[np.ndarray]] = [[], [], [], [], []]
        for row, raw in enumerate(utf8(batch.column(2))):
            for h, digest, first, size in regions_of(raw) if len(raw) >= DEPTH else ():
                for column, values in zip(found, (h.view(np.int64), digest.view(np.int64), np.full(len(h), row), first, size), strict=True):
                    column.append(values)
        if found[0]:
            h, digest, row, first, size = map(np.concatenate, found)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(digest), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(first, pa.int64()), pa.array(size, pa.int32())], names=["h", "digest", "id", "mark", "first", "size"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, parts) to the texts of their regions."""
    for batch in slices(batches, 0):
        rows = [(p["h"], p["digest"], p["n"] > 1, p["blocks"], raw[p["first"] : p["first"] + p["size"]]) for raw, parts in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), strict=True) for p in parts]
        h, digest, many, blocks, text = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(digest, pa.int64()), pa.array(many), pa.array(blocks, pa.int32()), pa.array(text, pa.binary())], names=["h", "digest", "many", "blocks", "text"])


def runs(flags: np.ndarray) -> list[int]:
    """Covered bytes of a region: first and end of every run, in turn, for flags of its windows."""
    if flags.all():
        return [0, len(flags) + DEPTH - 1]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    edges[1::2] += DEPTH - 1
    return edges.tolist()


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, side, digest, many, text) in order of h and side to the covered runs of the regions that have some."""

    def shard(rows: list[tuple]) -> pa.RecordBatch:
        found = [(h, digest, runs(flags | many)) for (h, _, digest, many, _), flags in zip(rows, repeated([r[4] for r in rows]), strict=True) if many or flags.any()]
        h, digest, covered = zip(*found, strict=True) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(digest, pa.int64()), pa.array(covered, pa.list_(pa.int32()))], names=["h", "digest", "covered"])

    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
            # an anchor's regions stay together; two pairs of its blocks share regions and must not meet
            if held and (size >= SHARD_BYTES if row[0] != held[-1][0] else row[1] != held[-1][1]):
                yield shard(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield shard(held)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, parts) to one row for each window of hot regions: (h, digest, many, at, window)."""
    for batch in slices(batches, 0):
        for raw, parts in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            for p in parts:
                n = p["size"] - DEPTH + 1
                keys = [hashlib.blake2b(raw[p["first"] + i : p["first"] + i + DEPTH], digest_size=16).digest() for i in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([p["h"]] * n, pa.int64()), pa.array([p["digest"]] * n, pa.int64()), pa.array([p["n"] > 1] * n), pa.array(range(n), pa.int32()), pa.array(keys, pa.binary())], names=["h", "digest", "many", "at", "window"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, digest, windows, hit windows) to covered runs."""
    for batch in batches:
        out = []
        for n, hit in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            flags = np.zeros(n, bool)
            flags[hit] = True
            out.append(runs(flags))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], names=["h", "digest", "covered"])


COVERED = "h long, digest long, covered array<int>"


def _by_document(classes: DataFrame) -> DataFrame:
    """The regions to cut from each document: as many as it is long allows."""
    return classes.groupBy("id", "mark").agg(F.collect_list(F.struct("h", "digest", "n", "first", "size", "blocks")).alias("parts"))


def _hot(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Covered runs of regions whose anchor has more distinct regions than a shard may hold: windows alone are dealt and counted."""
    rows = written(_by_document(classes).join(texts, ["id", "mark"]).select("text", "parts").mapInArrow(lean(_windows), "h long, digest long, many boolean, at int, window binary"), "windows")
    again = rows.groupBy("window").count().where("count > 1").select("window", F.lit(True).alias("again"))
    told = rows.join(again, "window", "left").withColumn("hit", F.col("many") | F.col("again").isNotNull())
    each = told.groupBy("h", "digest").agg(F.count("*").cast("int").alias("n"), F.collect_list(F.when(F.col("hit"), F.col("at"))).alias("at"))
    return each.where(F.size("at") > 0).mapInArrow(lean(_joined), COVERED)


def covered_regions(docs: DataFrame, hot: int | None = None) -> DataFrame:
    """docs (id, mark, text binary) to rows (id, mark, parts): the covered runs (first, covered) of each document that has some."""
    hot = hot or HOT
    spark = docs.sparkSession
    every = written(docs.mapInArrow(lean(_regions), "h long, digest long, id long, mark long, first long, size int"), "regions")
    # a table of its own, so that the join below is free to split a hot anchor's rows
    twice = written(every.groupBy("h").agg(F.count("*").alias("regions")).where("regions > 1").select("h"), "anchors")
    regions = written(every.join(twice, "h", "left_semi"), "repeated")
    drop_written(every)
    drop_written(twice)
    _forget(spark)
    each = written(regions.groupBy("h", "digest").agg(F.count("*").alias("n"), F.min(F.struct("id", "mark", "first", "size")).alias("one")).select("h", "digest", "n", "one.*"), "each")
    groups = written(each.groupBy("h").agg(F.count("*").alias("distinct")), "groups")
    classes = written(each.join(groups, "h").withColumn("blocks", F.ceil(F.col("distinct") / BLOCK).cast("int")), "classes")
    drop_written(each)
    drop_written(groups)
    _forget(spark)
    usual = _by_document(classes.where(F.col("distinct") <= hot))
    cut = usual.join(docs, ["id", "mark"]).select("text", "parts").mapInArrow(lean(_cut), "h long, digest long, many boolean, blocks int, text binary")
    mine = F.pmod(F.xxhash64("digest", "h"), F.col("blocks").cast("long")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != mine)
    sides = F.when(F.col("blocks") <= 2, F.array(F.lit(0))).otherwise(F.transform(others, lambda x: F.least(x, mine) * F.col("blocks") + F.greatest(x, mine)))
    dealt = cut.select("h", F.explode(sides).alias("side"), "digest", "many", "text").repartition("h", "side").sortWithinPartitions("h", "side")
    covered = written(dealt.mapInArrow(lean(_sort), COVERED), "covered")
    _forget(spark)
    if classes.where(F.col("distinct") > hot).limit(1).count():
        covered = covered.unionByName(written(_hot(classes.where(F.col("distinct") > hot), docs), "covered"))
    hits = regions.join(covered, ["h", "digest"]).select("id", "mark", "first", "covered")
    found = written(hits.groupBy("id", "mark").agg(F.collect_list(F.struct("first", "covered")).alias("parts")), "hits")
    for done in (regions, classes, covered):
        drop_written(done)
    _forget(spark)
    return found


def _forget(spark) -> None:
    """Let go of the shuffle files of finished steps, whose results are written.

    Spark deletes them once the driver's garbage collection has seen their plans go; nothing but disk depends on it.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def kept_bytes(raw: bytes, parts: list[dict] | None) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, maximal removed runs)."""
    if not parts:
        return raw, 0, 0
    change = np.zeros(len(raw) + 1, np.int32)
    for p in parts:
        edges = np.array(p["covered"], np.int64) + p["first"]
        np.add.at(change, edges[::2], 1)
        np.add.at(change, edges[1::2], -1)
    gone = np.cumsum(change[:-1]) > 0
    starts = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), int(gone.sum()), starts


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> list:
    """A row is known by its id and a hash of its text; repeated rows share both, and the same bytes go from them."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(F.col(text_col)).alias("mark"), text.alias("text")]


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int | None = None) -> DataFrame:
    """One row per row of docs: (id_col, n_bytes, n_removed, n_spans, kept_sha256, kept binary).

    Null texts are empty; texts of under 200 bytes lose nothing. Repeated rows are documents of their own,
    so that each repeats the other. Null ids count as one more id. An empty table gives no rows; other
    columns are not looked at.
    """
    keyed = docs.select(*_keyed(docs, id_col, text_col))
    found = covered_regions(keyed, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(len(raw), *kept_bytes(raw, parts)) for raw, parts in zip(utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True)]
            n, kept, gone, spans = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary())], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    rows = keyed.join(found, ["id", "mark"], "left").select("id", "text", "parts")
    out = rows.mapInArrow(lean(run), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.select(F.when(F.col("id") != -(1 << 63), F.col("id")).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The rows of docs with what is left of their texts (characters that lost a byte go) and its length in chars_col.

    Rows of whose text nothing is left are dropped; null and empty texts lose nothing and stay as they are, in
    every column. Long texts are whole; repeated rows are documents of their own, so that each repeats the
    other; null ids count as one more id; equal texts of 200 bytes or more all go. An empty table stays empty.
    """
    names, kinds = docs.columns, docs.schema
    keyed = docs.select(*_keyed(docs, id_col, text_col), F.col(text_col).isNull().alias("__null"), *(F.col(c).alias(f"__{i}") for i, c in enumerate(names) if c != text_col))
    found = covered_regions(keyed.select("id", "mark", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            whole = utf8(batch.column(0))
            parts = batch.column(1).to_pylist()
            texts = [kept_bytes(raw, p)[0].decode("utf-8", "ignore") for raw, p in zip(whole, parts, strict=True)]
            stays = pa.array([bool(t) or not p for t, p in zip(texts, parts, strict=True)])
            left = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *batch.columns[1:]], names=batch.schema.names)
            yield left.filter(stays)

    rows = keyed.join(found, ["id", "mark"], "left").select("text", "parts", "__null", *(f"__{i}" for i, c in enumerate(names) if c != text_col))
    schema = ", ".join(["text string", f"parts {rows.schema['parts'].dataType.simpleString()}", "__null boolean", *(f"__{i} {kinds[c].dataType.simpleString()}" for i, c in enumerate(names) if c != text_col)])
    out = rows.mapInArrow(lean(run), schema)
    chars = lambda c, i: F.when(F.col("parts").isNotNull(), F.length("text").cast(kinds[c].dataType)).otherwise(F.col(f"__{i}"))
    return out.select(*(F.when(~F.col("__null"), F.col("text")).alias(c) if c == text_col else (chars(c, i) if c == chars_col else F.col(f"__{i}")).alias(c) for i, c in enumerate(names)))
