"""Benchmark decontamination by suffix arrays over the training text.

Every task goes through shards of the training documents. It numbers their words by the benchmark's
vocabulary and sorts, to a suffix array, all suffixes that open with words some benchmark item has in a
row (no other suffix can match). Every suffix of every item is found in it by binary search. The place
of a test suffix between its neighbours tells the longest verbatim match of every training suffix, with
item, places and length; the range of the array that starts with an item's window is all its locations.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, slices, utf8, written

WINDOW, SHARE = 13, 20
#: Words in a row that a suffix must share with an item to be sorted; shorter matches count only if they are a whole item.
OPENING = 4
#: Benchmark text that is broadcast at once; a larger benchmark goes in several rounds, a block each.
BLOCK_BYTES = 4 << 20
#: Text of a shard, whose arrays take some forty times as much memory.
SHARD_BYTES = 3 << 20
_M = np.uint64(0x9E3779B97F4A7C15)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and a random number of each byte (the same for both cases of A-Z)."""
    word = np.zeros(256, bool)
    word[0x30:0x3A] = word[0x41:0x5B] = word[0x61:0x7B] = word[0x80:] = True
    value = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    value[0x41:0x5B] = value[0x61:0x7B]
    return word, value


IS_WORD, VALUE = _tables()
BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M
    return h ^ (h >> np.uint64(29))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of every word of a byte string, by differences of a running polynomial."""
    a = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(a) + 2, bool)
    inside[1:-1] = IS_WORD[a]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    n = 1 << max(16, len(a).bit_length())
    running = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(VALUE[a] * _powers(BASE, n)[: len(a)], out=running[1:])
    return starts, ends, _mix((running[ends] - running[starts]) * _powers(INVERSE, n)[starts])


class Members:
    """A set of 64-bit numbers: a bit table first, then binary search. find() gives positions, -1 for others."""

    def __init__(self, values: np.ndarray):
        self.sorted = np.unique(values)
        self.bits = max(16, int(len(self.sorted)).bit_length() + 5)
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self.sorted >> np.uint64(64 - self.bits)] = True

    def find(self, values: np.ndarray) -> np.ndarray:
        out = np.full(len(values), -1, np.int64)
        if len(self.sorted):
            may = np.flatnonzero(self.table[values >> np.uint64(64 - self.bits)])
            at = np.minimum(np.searchsorted(self.sorted, values[may]), len(self.sorted) - 1)
            hit = self.sorted[at] == values[may]
            out[may[hit]] = at[hit]
        return out


def _openings(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n word numbers from each place on; places without n words hash zeros in."""
    h = np.zeros(len(at), np.uint64)
    for k in range(n):
        h = _mix(h + ids[at + k].astype(np.uint64) * _M + np.uint64(k + 1))
    return h


CHUNK = np.arange(WINDOW)


def suffix_array(ids: np.ndarray, at: np.ndarray, longest: int) -> np.ndarray:
    """Places in the order of the suffixes that start there, WINDOW words at a time and further only where they tie. A zero ends a suffix."""
    rows = ids[at[:, None] + CHUNK]
    order = np.lexsort(rows.T[::-1])
    at, rows = at[order], rows[order]
    head = np.ones(len(at), bool)
    head[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    goes_on = rows.all(axis=1)
    for depth in range(WINDOW, longest, WINDOW):
        group = np.cumsum(head) - 1
        tied = np.flatnonzero((np.bincount(group)[group] > 1) & goes_on) if len(at) else at
        if not len(tied):
            break
        rows = ids[at[tied][:, None] + depth + CHUNK]
        order = np.lexsort((*rows.T[::-1], group[tied]))
        at[tied], rows, group = at[tied][order], rows[order], group[tied]
        head[tied[1:]] |= (rows[1:] != rows[:-1]).any(axis=1) & (group[1:] == group[:-1])
        goes_on[:] = False
        goes_on[tied] = rows.all(axis=1)
    return at


def compare(ids: np.ndarray, a: np.ndarray, other: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words in common, whether the first is smaller) of suffixes of ids at a and of other at b, pair by pair."""
    common, less = np.zeros(len(a), np.int64), np.zeros(len(a), bool)
    rest, depth = np.arange(len(a)), 0
    while len(rest):
        x, y = ids[a[rest][:, None] + depth + CHUNK], other[b[rest][:, None] + depth + CHUNK]
        stop = (x != y) | (x == 0)
        ends, first = stop.any(axis=1), stop.argmax(axis=1)
        done, k = rest[ends], first[ends]
        common[done], less[done] = depth + k, x[ends, k] < y[ends, k]
        rest, depth = rest[~ends], depth + WINDOW
    return common, less


@dataclass
class Index:
    """A block of the benchmark: its vocabulary, its own sorted suffixes, distinct windows and the items of each."""

    vocabulary: Members
    spelt: list[bytes]  # in the order of the vocabulary
    openings: dict[int, Members]  # by number of words: OPENING, and those of shorter items
    longest: int
    ids: np.ndarray  # word numbers from 1 of all items, a zero after each
    names: list[str]
    item: np.ndarray  # of each place
    first: np.ndarray  # place of each item's first word
    suffixes: np.ndarray
    suffix_opens: np.ndarray
    windows: np.ndarray  # (windows, WINDOW) word numbers, zeros after a short item's end
    lengths: np.ndarray
    window_opens: np.ndarray
    items: list[list[str]]


def index(items: list[tuple[str, bytes]]) -> Index:
    """Suffixes and windows of the items (id, text): WINDOW words in a row, or all of a shorter item."""
    found = [word_hashes(t) for _, t in items]
    flat = np.concatenate([h for *_, h in found]) if found else np.zeros(0, np.uint64)
    vocabulary = Members(flat)
    spelling = dict(zip(flat.tolist(), (t[a:b].lower() for (_, t), (starts, ends, _) in zip(items, found, strict=True) for a, b in zip(starts, ends, strict=True)), strict=True))
    sizes = np.array([len(h) for *_, h in found], np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    longest = int(sizes.max()) if len(sizes) else 0
    ids = np.zeros(int((sizes + 1).sum()) + longest + 2 * WINDOW, np.int32)
    item = np.repeat(np.arange(len(items)), sizes)
    place = np.arange(len(item)) + item
    ids[place] = vocabulary.find(flat) + 1
    item_of = np.zeros(len(ids), np.int64)
    item_of[place] = item
    windows: dict[bytes, tuple[int, set[str]]] = {}
    for (name, _), start, size in zip(items, first.tolist(), sizes.tolist(), strict=True):
        n = min(size, WINDOW)
        for i in range(start, start + size - n + 1) if n else ():
            row = np.zeros(WINDOW, np.int32)
            row[:n] = ids[i : i + n]
            windows.setdefault(row.tobytes(), (n, set()))[1].add(name)
    rows = np.frombuffer(b"".join(windows), np.int32).reshape(-1, WINDOW)
    lengths = np.array([n for n, _ in windows.values()], np.int64)
    padded = np.concatenate([rows.ravel(), np.zeros(OPENING, np.int32)])
    opens = {n: _openings(padded, np.flatnonzero(lengths >= n if n == OPENING else lengths == n) * WINDOW, n) for n in sorted({OPENING, *lengths[lengths < OPENING].tolist()})}
    suffixes = suffix_array(ids, place, longest)
    suffix_opens = _openings(ids, suffixes, OPENING)
    long = ids[suffixes + OPENING - 1] > 0  # all words up to there are of the same item: a zero stands between items
    for k in range(OPENING - 1):
        long &= ids[suffixes + k] > 0
    suffixes, suffix_opens = suffixes[long], suffix_opens[long]
    members = {n: Members(h) for n, h in opens.items()}
    members[OPENING] = Members(suffix_opens)
    window_opens = np.zeros(len(rows), np.uint64)
    for n, h in opens.items():
        window_opens[lengths >= n if n == OPENING else lengths == n] = h
    return Index(vocabulary, [spelling[h] for h in vocabulary.sorted.tolist()], members, longest, ids, [name for name, _ in items], item_of, first, suffixes, suffix_opens, rows, lengths, window_opens, [sorted(s) for _, s in windows.values()])


def _bounds(rows: np.ndarray, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range of the sorted rows that start with each window, by binary search of all windows at once."""
    mask = np.arange(WINDOW) < lengths[:, None]

    def search(past_equal: bool) -> np.ndarray:
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(rows), np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            row, want = rows[middle], windows[open_]
            differ = (row != want) & mask[open_]
            first = differ.argmax(axis=1)
            each = np.arange(len(open_))
            right = np.where(differ[each, first], row[each, first] < want[each, first], past_equal)
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
        return low

    return search(False), search(True)


@dataclass
class Found:
    """What a shard holds of a block: covered places, items by document, and per place the longest match and the test suffix of it."""

    covered: np.ndarray
    items: list[set[str]]
    words: np.ndarray
    suffix: np.ndarray


class Shard:
    """Hashed words of several documents, with a gap after each."""

    def __init__(self, texts: list[bytes | None]):
        self.raw = b"\0".join(t or b"" for t in texts)
        sizes = np.array([len(t or b"") + 1 for t in texts], np.int64)
        self.starts, self.ends, self.hashes = word_hashes(self.raw)
        self.doc = np.searchsorted(np.cumsum(sizes), self.starts, "right")
        self.n_words = np.bincount(self.doc, minlength=len(texts))
        self.first = np.cumsum(self.n_words) - self.n_words  # each document's first word
        self.place = np.arange(len(self.starts)) + self.doc  # a place without a word stands between documents
        self.size = len(self.starts) + len(texts)
        self.doc_of = np.zeros(self.size, np.int64)
        self.doc_of[self.place] = self.doc

    def found(self, block: Index) -> Found:
        """Search a block. Words are equal by hash first; what a match holds is compared by its bytes."""
        ids = np.zeros(self.size + block.longest + 2 * WINDOW, np.int32)
        ids[self.place] = block.vocabulary.find(self.hashes) + 1
        while True:
            got = self._search(block, ids)
            inside = np.zeros(self.size + 1, np.int64)
            some = np.flatnonzero(got.words)
            np.add.at(inside, some, 1)
            np.add.at(inside, some + got.words[some], -1)
            held = np.flatnonzero((np.cumsum(inside[:-1]) + got.covered)[self.place] > 0)
            wrong = [i for i in held.tolist() if self.raw[self.starts[i] : self.ends[i]].lower() != block.spelt[ids[self.place[i]] - 1]]
            if not wrong:
                return got
            ids[self.place[wrong]] = 0

    def _search(self, block: Index, ids: np.ndarray) -> Found:
        at = self.place[ids[self.place] > 0]
        opened = np.zeros(self.size, bool)
        kept, run = at, 1
        for n in sorted(block.openings):
            while run < n:
                kept = kept[ids[kept + run] > 0]
                run += 1
            opened[kept[block.openings[n].find(_openings(ids, kept, n)) >= 0]] = True
        at = suffix_array(ids, at[opened[at]], block.longest)
        items: list[set[str]] = [set() for _ in self.n_words]
        edges, words, suffix = np.zeros(self.size + 1, np.int64), np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        if not len(at):
            return Found(edges[:-1], items, words, suffix)
        here = Members(_openings(ids, at, OPENING))
        # every test suffix to its place in the array; those whose first words are nowhere in the shard match nothing
        test = block.suffixes[here.find(block.suffix_opens) >= 0]
        if len(test):
            low, high = np.zeros(len(test), np.int64), np.full(len(test), len(at), np.int64)
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) >> 1
                _, right = compare(ids, at[middle], block.ids, test[open_])
                low[open_[right]] = middle[right] + 1
                high[open_[~right]] = middle[~right]
            # a training suffix has its longest match with the test suffix before or after it
            after = np.searchsorted(low, np.arange(len(at)), "right")
            for t in (np.maximum(after - 1, 0), np.minimum(after, len(test) - 1)):
                common, _ = compare(ids, at, block.ids, test[t])
                better = (common >= OPENING) & (common > words[at])
                words[at[better]], suffix[at[better]] = common[better], test[t[better]]
        rows = ids[at[:, None] + CHUNK]
        window = np.flatnonzero((block.lengths < OPENING) | (here.find(block.window_opens) >= 0))
        low, high = _bounds(rows, block.windows[window], block.lengths[window])
        counts = high - low
        window = np.repeat(window, counts)
        places = at[np.repeat(low, counts) + np.arange(len(window)) - np.repeat(np.cumsum(counts) - counts, counts)]
        np.add.at(edges, places, 1)
        np.add.at(edges, places + block.lengths[window], -1)
        if len(places):
            for d, w in np.unique(np.stack([self.doc_of[places], window], axis=1), axis=0):
                items[d].update(block.items[w])
        np.maximum.at(words, places, block.lengths[window])
        return Found((np.cumsum(edges[:-1]) > 0).astype(np.int64), items, words, suffix)

    def matches(self, block: Index, got: Found) -> list[list[dict]]:
        """Of each document the longest matches that no match one word earlier holds: where they start, in the document and in an item."""
        out: list[list[dict]] = [[] for _ in self.n_words]
        words = got.words
        starts = np.flatnonzero((words >= OPENING) & (words != np.concatenate([[0], words[:-1]]) - 1))
        for p in starts.tolist():
            d, t = int(self.doc_of[p]), int(got.suffix[p])
            i = int(block.item[t])
            out[d].append({"item": block.names[i], "item_word": t - int(block.first[i]), "word": p - d - int(self.first[d]), "words": int(words[p])})
        return out

    def runs(self, covered: np.ndarray) -> list[list[dict]]:
        """Covered words of each document: the first of every run, and the one after its last."""
        out: list[list[dict]] = [[] for _ in self.n_words]
        at = np.flatnonzero(covered[self.place] > 0)
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (np.diff(self.doc[at]) > 0)
        starts = np.flatnonzero(new)
        for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(at)], strict=False):
            d = int(self.doc[at[i]])
            out[d].append({"a": int(at[i] - self.first[d]), "b": int(at[j - 1] - self.first[d]) + 1})
        return out


def blocks_of(benchmark: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's items in blocks of bounded size, one at a time. Null texts have no words; a null id counts as an empty one."""
    held, size = [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    for r in rows.toLocalIterator():
        held.append((r.id, bytes(r.text)))
        size += len(r.text)
        if size > BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


_SPAN = "array<struct<item string, item_word int, word int, words int>>"
_ROUND = f"id long, mark long, n_words long, covered array<struct<a int, b int>>, items array<string>, longest_match long, matches {_SPAN}"


def _round(docs: DataFrame, items: list[tuple[str, bytes]], every: bool) -> DataFrame:
    """One block against docs (id, mark, text): rows of _ROUND, of documents with a match alone unless every."""
    block = docs.sparkSession.sparkContext.broadcast(index(items))
    run_of = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    span = pa.list_(pa.struct([("item", pa.string()), ("item_word", pa.int32()), ("word", pa.int32()), ("words", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, SHARD_BYTES):
            shard = Shard(utf8(batch.column(2)))
            got = shard.found(block.value)
            longest = np.zeros(len(shard.n_words), np.int64)
            np.maximum.at(longest, shard.doc, got.words[shard.place])
            columns = [batch.column(0), batch.column(1), pa.array(shard.n_words, pa.int64()), pa.array(shard.runs(got.covered), run_of), pa.array([sorted(s) for s in got.items], pa.list_(pa.string())), pa.array(longest, pa.int64()), pa.array(shard.matches(block.value, got), span)]
            out = pa.RecordBatch.from_arrays(columns, names=["id", "mark", "n_words", "covered", "items", "longest_match", "matches"])
            yield out if every else out.filter(pa.array(longest > 0))

    return docs.mapInArrow(lean(run), _ROUND)


def _keyed(docs: DataFrame) -> list:
    """A row is known by its id and a hash of its text; what rows share both of is judged alike."""
    return [F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("mark"), F.col("text")]


def _total(runs: Column) -> Column:
    """Number of words that runs (a, b) cover together; they may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(F.array_sort(runs), start, lambda s, p: F.struct((s["n"] + F.greatest(F.lit(0), p["b"] - F.greatest(p["a"], s["end"]))).alias("n"), F.greatest(s["end"], p["b"]).alias("end")), lambda s: s["n"])


def search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of docs: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match, items, matches).

    longest_match: the most words in a row that the document has in common with an item, of OPENING words or
    more, or a whole shorter item. matches: every longest match of OPENING words or more that none one word
    earlier holds, as (item, item_word, word, words): an item that holds it, the word of the item and of the
    document where it starts, both from 0, and its length; of several items with the same words any is named.
    items: the ids behind items_sha256. Null and empty texts have no words and are clean; texts of any length
    are whole; null ids and repeated rows are judged like others; an empty benchmark hits nothing; an empty
    table gives no rows; other columns are not looked at.

    Only one block of the benchmark is broadcast and held at a time: the first goes over every document, what
    further ones find is written, without texts, and joined. Equal rows of docs find equal things, so that
    joining by id and text hash is exact.
    """
    return _judged(docs, benchmark).withColumnRenamed("id", "doc_id").drop("mark")


def _judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of search with (id, mark) in place of doc_id."""
    keyed = docs.select(*_keyed(docs))
    blocks = blocks_of(benchmark)
    first = next(blocks, [])
    rows, more = _round(keyed, first, True), None
    for items in blocks:
        if more is None:
            rows = written(rows, "first")
        part = written(_round(keyed, items, False), "block")
        more = part if more is None else more.unionByName(part)
    if more is None:
        told = rows.select("id", "mark", "n_words", _total(F.col("covered")).alias("n_hit"), "items", "longest_match", "matches")
    else:
        again = more.where("longest_match > 0").select("id", "mark", "covered", "items", "longest_match", "matches").distinct()
        again = again.groupBy("id", "mark").agg(F.flatten(F.collect_list("covered")).alias("c"), F.flatten(F.collect_list("items")).alias("i"), F.max("longest_match").alias("l"), F.flatten(F.collect_list("matches")).alias("m"))
        joined = rows.alias("r").join(again.alias("a"), F.col("r.id").eqNullSafe(F.col("a.id")) & (F.col("r.mark") == F.col("a.mark")), "left")
        told = joined.select(
            F.col("r.id").alias("id"),
            F.col("r.mark").alias("mark"),
            "n_words",
            _total(F.concat("r.covered", F.coalesce("c", F.array().cast("array<struct<a int, b int>>")))).alias("n_hit"),
            F.array_sort(F.array_distinct(F.concat("r.items", F.coalesce("i", F.array().cast("array<string>"))))).alias("items"),
            F.greatest("r.longest_match", F.coalesce("l", F.lit(0))).alias("longest_match"),
            F.concat("r.matches", F.coalesce("m", F.array().cast(_SPAN))).alias("matches"),
        )
    dirty = (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))
    return told.select("id", "mark", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), dirty.alias("contaminated"), "longest_match", "items", "matches")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns.

    Nulls, empty and long texts, repeated rows and empty tables are as in search: rows without words stay.
    A benchmark of one block is a map over docs, without a shuffle; of more, contaminated rows are found by
    search and taken out by id and text hash.
    """
    blocks = blocks_of(benchmark)
    first = next(blocks, [])
    if next(blocks, None) is not None:
        dirty = written(_judged(docs, benchmark).where("contaminated").select(F.col("id").alias("__id"), F.col("mark").alias("__mark")), "dirty")
        return docs.join(dirty, docs["doc_id"].cast("long").eqNullSafe(dirty["__id"]) & (F.xxhash64(docs["text"]) == dirty["__mark"]), "left_anti")
    block, at = docs.sparkSession.sparkContext.broadcast(index(first)), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at, SHARD_BYTES):
            shard = Shard(utf8(batch.column(at)))
            covered = np.bincount(shard.doc, shard.found(block.value).covered[shard.place], len(shard.n_words))
            yield batch.filter(pa.array((covered == 0) | (SHARE * covered < shard.n_words)))

    return docs.mapInArrow(lean(run), docs.schema)


def sql() -> str:
    """The same over ``documents`` and ``benchmark`` in DuckDB's SQL, without the columns beyond the contract."""
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH dw AS (SELECT doc_id, {words} AS w FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark),
il AS (SELECT item, w, least({WINDOW}, len(w)) AS l FROM iw WHERE len(w) > 0),
wins AS (SELECT DISTINCT item, l, array_to_string(w[i : i + l - 1], ' ') AS win FROM (SELECT item, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM il)),
ls AS (SELECT DISTINCT l FROM il),
places AS (SELECT doc_id, l, i, array_to_string(w[i : i + l - 1], ' ') AS win FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM dw, ls WHERE len(w) >= l)),
hits AS (SELECT doc_id, i, l, item FROM places JOIN wins USING (l, win)),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS k FROM (SELECT DISTINCT doc_id, i, l FROM hits)) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
