"""Best-fit packing of tokenised documents into fixed-length sequences.

Each task packs what it reads, online, with a fixed number of open bins. A bitset holds a bit for
every amount of free space that some open bin has, so the best fit is the lowest set bit at or above
a piece's length. With all bins open and none that fits, the fullest closes. What a task leaves open
at its end travels on as blocks that a second, much smaller round packs in the same way.
"""

from __future__ import annotations

import functools
import re
import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, utf8, written

LENGTH, END, OPEN_BINS = 2048, 0, 512
#: How the byte-level vocabulary cuts a text before it merges bytes, and its one special token.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = "<|endoftext|>"
#: Separators of information, which not all regular expressions count as space.
APART = ("\x1c", "\x1d", "\x1e", "\x1f", SPECIAL)
#: Whitespace characters in a row that the faster pattern takes: its stack overflows somewhere above 900,000.
RUN = 100_000


def runs_long(text: str) -> bool:
    """Whether more than RUN whitespace characters stand in a row."""
    return len(text) > RUN and any(m.end() - m.start() > RUN for m in re.finditer(r"\s+", text))


def byte_of() -> dict[str, int]:
    """The printable character by which byte-level vocabularies write each byte: its own, or the next free one from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return {chr(b if b in own else next(spare)): b for b in range(256)}


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes, those that ``tokenizers`` gives for the file at path.

    The file's vocabulary merges by id, so the faster merges of ``tiktoken`` give the same ids from the same
    file; texts with something set APART or a whitespace run above RUN go through ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        byte = byte_of()
        ranks = {bytes(byte[c] for c in token): i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token != SPECIAL}
        self.fast = tiktoken.Encoding("byte-level", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids if any(a in text for a in APART) or runs_long(text) else self.fast(text)
        return (array("I", ids) if sys.byteorder == "little" else np.array(ids, "<u4")).tobytes()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Bins:
    """Open bins, keyed by free space. place() gives (bin number, offset)."""

    def __init__(self, length: int = LENGTH, most: int = OPEN_BINS):
        self.length, self.most, self.open, self.made, self.free = length, most, 0, 0, 0
        self.by_free: dict[int, list[int]] = defaultdict(list)

    def _take(self, space: int) -> int:
        held = self.by_free[space]
        number = held.pop()
        if not held:
            self.free &= ~(1 << space)
        self.open -= 1
        return number

    def _put(self, space: int, number: int) -> None:
        if space:
            self.by_free[space].append(number)
            self.free |= 1 << space
            self.open += 1

    def place(self, size: int) -> tuple[int, int]:
        fits = self.free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            if self.open >= self.most:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest
            space, number = self.length, self.made
            self.made += 1
        self._put(space - size, number)
        return number, self.length - space

    def left(self) -> dict[int, int]:
        """Open bins: number to tokens held."""
        return {n: self.length - space for space, numbers in self.by_free.items() for n in numbers}


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole lengths at its end, what is left over first."""
    first = n % length
    return ([(0, first)] if first else []) + [(at, length) for at in range(first, n, length)]


PIECE = "id {id}, piece int, start long, length long, ids_crc32 long, bin long, offset long, open boolean, held long"


def _pieces(path: str, length: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins, base, end = encoder(path), Bins(length, most), TaskContext.get().partitionId() << 32, np.array([END], "<u4").tobytes()
        kind, waiting = None, []
        for batch in batches:
            kind, rows = batch.column(0).type, []
            for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                ids = encode((text or b"").decode("utf-8", "replace")) + end
                rows += [(doc, k, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)])) for k, (at, n) in enumerate(cut(len(ids) // 4, length))]
            rows.sort(key=lambda r: -r[3])  # of the pieces at hand the longest go first
            placed = [(*r, *bins.place(r[3])) for r in rows]
            still = bins.left()
            # rows of bins still open wait for the end: only then is it known what their bin holds
            waiting += placed
            ready = [r for r in waiting if r[5] not in still]
            waiting = [r for r in waiting if r[5] in still]
            if ready:
                yield _batch(ready, base, {}, kind)
        if waiting:
            yield _batch(waiting, base, bins.left(), kind)

    return pack


def _batch(rows: list[tuple], base: int, still: dict[int, int], kind: pa.DataType) -> pa.RecordBatch:
    doc, piece, start, length, crc, number, offset = zip(*rows, strict=True)
    columns = [pa.array(doc, kind), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc, [base + n for n in number], offset))]
    columns += [pa.array([n in still for n in number]), pa.array([still.get(n, 0) for n in number], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["id", "piece", "start", "length", "ids_crc32", "bin", "offset", "open", "held"])


def _blocks(length: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = Bins(length, most), (TaskContext.get().partitionId() << 32) | 1 << 62
        for batch in batches:
            rows = sorted(zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True), reverse=True)
            placed = [(b, *bins.place(held)) for held, b in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in placed], pa.int64()), pa.array([base + r[1] for r in placed], pa.int64()), pa.array([r[2] for r in placed], pa.int64())], names=["bin", "into", "shift"])

    return pack


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, open_bins: int = OPEN_BINS) -> DataFrame:
    """One row per piece: (id_col, piece, start, length, ids_crc32, sequence_id, offset).

    A document is its token ids and then id END, so null and empty texts are one token. Documents
    longer than a sequence are cut into whole lengths from their end; their first piece may be shorter.
    tokenizer: the path of a byte-level vocabulary that every executor can read. Repeated rows and null
    ids are packed like others; pieces of equal length go in the order in which they are read, and of equal
    bins the one opened last is taken; an empty table has no pieces; other columns are not looked at.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    pieces = written(map_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), _pieces(tokenizer, length, open_bins), PIECE.format(id=kind)), "pieces")
    # A block per open bin; they are open_bins a task at most. Dealt over a sixteenth of the tasks.
    blocks = pieces.where("open").groupBy("bin").agg(F.max("held").alias("held"))
    tasks = 1 + len(pieces.inputFiles()) // 16
    moved = blocks.repartition(tasks, F.pmod(F.hash("bin"), F.lit(tasks))).sortWithinPartitions(F.desc("held"), "bin").mapInArrow(_blocks(length, open_bins), "bin long, into long, shift long")
    return pieces.join(moved, "bin", "left").select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", F.coalesce("into", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))
