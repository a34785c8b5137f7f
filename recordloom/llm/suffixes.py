"""Two-stage suffix sorting of byte strings, to a depth.

Stage one sorts directly only the suffixes that are smaller than their successors. Stage two walks the
buckets of first bytes in order: a suffix that is larger than its successor lands in its bucket when
the walk comes to that successor, so it is never compared.
"""

from __future__ import annotations

import numpy as np

#: Common prefixes are told up to this many bytes, a whole number of 8-byte words.
DEPTH = 200
PAD = DEPTH + 56


def words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as a number that sorts like them; the text must be padded."""
    out = np.zeros(len(text) // 8 * 8, np.uint64)
    for shift in range(8):
        part = text[shift:]
        part = part[: len(part) // 8 * 8].view(">u8")
        out[shift::8][: len(part)] = part
    return out


def smaller(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors; the last one counts as such."""
    n = len(text)
    rises = np.ones(n, bool)
    rises[:-1] = text[:-1] < text[1:]
    differs = np.ones(n, bool)
    differs[:-1] = text[:-1] != text[1:]
    at = np.where(differs, np.arange(n), n)
    return rises[np.minimum.accumulate(at[::-1])[::-1]]


def direct(places: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Places in the order of their suffixes' first DEPTH bytes; a group of equal prefixes is sorted again only where it differs."""
    key = w[places]
    order = np.argsort(key, kind="stable")
    found, key = places[order], key[order]
    head = np.ones(len(found) + 1, bool)
    head[1:-1] = key[1:] != key[:-1]
    at = np.flatnonzero(~(head[:-1] & head[1:]))
    for k in range(8, DEPTH, 8):
        if not len(at):
            break
        key = w[found[at] + k]
        start = np.flatnonzero(head[at])
        group = np.cumsum(head[at]) - 1
        mixed = np.logical_or.reduceat(key != key[start][group], start)
        if mixed.any():
            which = mixed[group]
            of, key, group = at[which], key[which], group[which]
            order = np.lexsort((key, group))
            found[of], key = found[of][order], key[order]
            head[of[1:]] |= (key[1:] != key[:-1]) & (group[1:] == group[:-1])
            at = at[~(head[at] & head[at + 1])]
    return found


def two_stage(text: np.ndarray, wanted: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The wanted places of a padded text (a mask), in the order of their suffixes to DEPTH bytes or more."""
    small = smaller(text)
    # a larger suffix is induced by its successor, so every place up to the next smaller one joins
    joins = wanted | _carried(wanted, small)
    large = joins & ~small
    first = direct(np.flatnonzero(joins & small), w)
    cuts = np.searchsorted(text[first], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []

    def induce(ordered: np.ndarray, c: int) -> np.ndarray:
        """Send the larger predecessors of ordered suffixes to their buckets; those of bucket c itself come back."""
        p = ordered[ordered > 0] - 1
        p = p[large[p]]
        byte = text[p]
        own = p[byte == c]
        p, byte = p[byte > c], byte[byte > c]
        if len(p):
            order = np.argsort(byte, kind="stable")
            p, byte = p[order], byte[order]
            starts = np.concatenate([[0], np.flatnonzero(byte[1:] != byte[:-1]) + 1, [len(p)]])
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                waiting[byte[a]].append(p[a:b])
        return own

    for c in range(256):
        wave = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(wave):
            out.append(wave)
            wave = induce(wave, c)
        own = first[cuts[c] : cuts[c + 1]]
        if len(own):
            out.append(own)
            induce(own, c)
    found = np.concatenate(out) if out else np.zeros(0, np.int64)
    return found[wanted[found]]


def _carried(wanted: np.ndarray, small: np.ndarray) -> np.ndarray:
    """Places to which a wanted larger suffix leads through larger ones."""
    n = len(wanted)
    at = np.arange(n)
    last_wanted = np.maximum.accumulate(np.where(wanted, at, -1))
    last_small = np.maximum.accumulate(np.where(small, at, -1))
    before = np.concatenate([[-1], last_small[:-1]])  # the last smaller suffix before each place
    return (last_wanted >= 0) & (before < last_wanted)


def common_prefixes(order: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Bytes that neighbours in the order have in common, in whole words, up to DEPTH."""
    out = np.zeros(max(len(order) - 1, 0), np.int64)
    at = np.arange(len(out))
    for k in range(0, DEPTH, 8):
        at = at[w[order[at] + k] == w[order[at + 1] + k]]
        if not len(at):
            break
        out[at] = k + 8
    return out


def repeated(parts: list[bytes], depth: int = DEPTH) -> list[np.ndarray]:
    """Of each part, which of its DEPTH-byte strings start somewhere else too, in any part; one flag per start."""
    assert depth == DEPTH
    sizes = np.array([len(p) for p in parts], np.int64)
    text = np.zeros((int(sizes.sum()) + PAD + 7) // 8 * 8, np.uint8)
    text[: sizes.sum()] = np.frombuffer(b"".join(parts), np.uint8)
    starts = np.cumsum(sizes) - sizes
    change = np.zeros(len(text) + 1, np.int8)
    counts = np.maximum(sizes - DEPTH + 1, 0)
    some = counts > 0
    change[starts[some]] += 1
    np.add.at(change, starts[some] + counts[some], -1)
    wanted = np.cumsum(change[:-1]) > 0
    w = words(text)
    order = two_stage(text, wanted, w)
    same = common_prefixes(order, w) >= DEPTH
    flags = np.zeros(len(text), bool)
    flags[order[:-1][same]] = True
    flags[order[1:][same]] = True
    return [flags[s : s + c] for s, c in zip(starts.tolist(), counts.tolist(), strict=True)]
