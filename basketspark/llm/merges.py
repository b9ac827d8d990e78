"""Vectorised byte-pair merges: many words at once on flat numpy symbol arrays.

Each round takes the smallest pair rank of every word (a segmented minimum), merges its
occurrences from the left in all words simultaneously, compacts the arrays, and drops the words
in which no pair is left. All occurrences of a word are merged in one round where no pair that a
merge makes, before or after its right neighbour is merged, ranks as low as the merged ones: then
a merge queue would take them one after another, too. Else the word's leftmost one is merged
alone. The result equals that of a merge queue, whatever the ranks.
"""

from __future__ import annotations

import numpy as np

from basketspark.llm.text import range_keys

NONE = np.int32(2**31 - 1)
_SHIFT = np.uint64(21)  # symbols are below 2**21
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Symbols worked on at once (one word at least).
SYMBOLS_AT_ONCE = 60_000


class MergeTable:
    """(left, right) -> (rank, merged symbol), looked up for whole arrays of pairs."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        keys = self._key(left, right)
        self.bits = np.uint64(64 - max(10, int(len(keys) * 4).bit_length()))
        size = 1 << int(64 - int(self.bits))
        slots: dict[int, int] = {}
        self.depth = 1
        for i, h in enumerate(((keys * _FACTOR) >> self.bits).tolist()):
            d = 0
            while h + d in slots:
                d += 1
            slots[h + d] = i
            self.depth = max(self.depth, d + 1)
        self.keys = np.full(size + self.depth, np.uint64(2**64 - 1), np.uint64)
        self.index = np.full(size + self.depth, len(keys), np.int32)
        at, i = np.fromiter(slots.keys(), np.int64), np.fromiter(slots.values(), np.int64)
        self.keys[at], self.index[at] = keys[i], i
        self.rank = np.append(rank.astype(np.int32), NONE)
        self.merged = np.append(merged.astype(np.int32), np.int32(-1))

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << _SHIFT) | right.astype(np.uint64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of each pair in the table; the table's length where there is none."""
        keys = self._key(left, right)
        slot = ((keys * _FACTOR) >> self.bits).astype(np.int64)
        seen = self.keys[slot]
        out = np.where(seen == keys, self.index[slot], len(self.rank) - 1)
        rest = np.flatnonzero((seen != keys) & (seen != np.uint64(2**64 - 1)))
        for d in range(1, self.depth):
            if not len(rest):
                break
            at = slot[rest] + d
            seen = self.keys[at]
            hit = seen == keys[rest]
            out[rest[hit]] = self.index[at[hit]]
            rest = rest[~hit & (seen != np.uint64(2**64 - 1))]
        return out


def _merging(sym: np.ndarray, word: np.ndarray, rank: np.ndarray, least: np.ndarray, table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """(where a pair is merged in this round, the symbols it becomes)."""
    hit = rank == least
    at = np.flatnonzero(hit)
    # Of pairs that overlap every other one, from the left.
    run = np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(at) > 1]), np.arange(len(at)), 0))
    at = at[(np.arange(len(at)) - run) % 2 == 0]
    merged = table.merged[table.find(sym[at], sym[at + 1])]
    first = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
    if first.all():
        return at, merged
    # Symbols next to each merge: on the left as it is once merged, on the right as it was.
    after = sym.copy()
    after[at] = merged
    left = at - 1
    left = np.where(first | (np.concatenate([[-2], at[:-1]]) + 1 < left), left, left - 1)  # the pair before is one symbol
    right = at + 2
    lowest = np.full(len(at), NONE, np.int32)
    for own, new in ((left, True), (right, False)):
        inside = np.flatnonzero((own >= 0) & (own < len(sym)) & (word[np.clip(own, 0, len(sym) - 1)] == word[at]))
        pair = (after[own[inside]], merged[inside]) if new else (merged[inside], sym[own[inside]])
        lowest[inside] = np.minimum(lowest[inside], table.rank[table.find(*pair)])
    begin = np.flatnonzero(first)
    safe = np.minimum.reduceat(np.where(lowest > least[at], 1, 0), begin) == 1
    taken = first | np.repeat(safe, np.diff(np.append(begin, len(at))))
    return at[taken], merged[taken]


def _rounds(symbols: np.ndarray, counts: np.ndarray, table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """(symbols left, how many per word) for words of counts[i] symbols each."""
    sym = symbols.astype(np.int32)
    word = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    rank = np.full(len(sym), NONE, np.int32)  # of the pair that begins at the symbol
    inside = np.flatnonzero(word[:-1] == word[1:])
    rank[inside] = table.rank[table.find(sym[inside], sym[inside + 1])]
    ended: list[tuple[np.ndarray, np.ndarray]] = []
    while len(sym):
        start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        size = np.diff(np.append(start, len(sym)))
        least = np.minimum.reduceat(rank, start)
        done = least == NONE
        if done.any():
            out = np.repeat(done, size)
            ended.append((word[out], sym[out]))
            sym, word, rank, least, size = sym[~out], word[~out], rank[~out], least[~done], size[~done]
            if not len(sym):
                break
        at, merged = _merging(sym, word, rank, np.repeat(least, size), table)
        sym[at] = merged
        stay = np.ones(len(sym), bool)
        stay[at + 1] = False
        sym, word, rank = sym[stay], word[stay], rank[stay]
        at = at - np.arange(len(at))  # one symbol went for each merge further left
        again = np.concatenate([at, at[at > 0] - 1])
        end = (again + 1 >= len(sym)) | (word[np.minimum(again + 1, len(sym) - 1)] != word[again])
        rank[again[end]] = NONE
        again = again[~end]
        rank[again] = table.rank[table.find(sym[again], sym[again + 1])]
    if not ended:
        return np.zeros(0, np.int32), np.zeros(len(counts), np.int64)
    words, left = np.concatenate([e[0] for e in ended]), np.concatenate([e[1] for e in ended])
    order = np.argsort(words, kind="stable")
    return left[order], np.bincount(words, minlength=len(counts))


def merge_words(symbols: np.ndarray, counts: np.ndarray, table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """(symbols left, how many per word), the words in their order. Words of like length are
    worked on together, so that few wait for the longest one."""
    counts = np.asarray(counts, np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    order = np.argsort(counts, kind="stable")
    left_counts = np.zeros(len(counts), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(order):
        total = np.cumsum(counts[order[at : at + SYMBOLS_AT_ONCE]])
        take = max(1, int(np.searchsorted(total, SYMBOLS_AT_ONCE)))
        which = order[at : at + take]
        left, n = _rounds(gather(symbols, first, which), counts[which], table)
        left_counts[which] = n
        parts.append((which, left))
        at += len(which)
    to = np.concatenate([[0], np.cumsum(left_counts)])
    out = np.empty(to[-1], np.int32)
    for which, left in parts:
        out[spread(to[which], left_counts[which])] = left
    return out, left_counts


def spread(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All indices of the ranges begin[i] .. begin[i] + counts[i], one after another."""
    total = int(counts.sum())
    return np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(total)


def gather(flat: np.ndarray, first: np.ndarray, which: np.ndarray) -> np.ndarray:
    """flat[first[w]:first[w + 1]] for each w, one after another."""
    return flat[spread(first[which], first[which + 1] - first[which])]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, one after another; where each begins and the last ends)."""
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.concatenate([[0], np.cumsum(counts)])


def encode_parts(points: np.ndarray, begin: np.ndarray, end: np.ndarray, encode) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all parts points[begin:end], one after another; ids per part). Each distinct part
    is encoded once by ``encode(points, counts)``; parts are told by a hash, and every one is
    compared with the part that stands for it."""
    if not len(begin):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    counts = end - begin
    points = np.ascontiguousarray(points, np.uint32)
    (keys,) = range_keys(points.view(np.uint8), 4 * begin, 4 * end)
    _, index, which = np.unique(keys, return_index=True, return_inverse=True)
    stands = index[which]
    other = counts != counts[stands]
    alike = np.flatnonzero(~other)
    own, as_own = (points[spread(b[alike], counts[alike])] for b in (begin, begin[stands]))
    differs = np.flatnonzero(own != as_own)
    if len(differs):  # of another part with the same hash
        other[alike[np.searchsorted(np.cumsum(counts[alike]), differs, "right")]] = True
    if other.any():
        alone = np.flatnonzero(other)
        index, which = np.concatenate([index, alone]), which.copy()
        which[alone] = len(index) - len(alone) + np.arange(len(alone))
    ids, n = encode(points[spread(begin[index], counts[index])], counts[index])
    return gather(ids, np.concatenate([[0], np.cumsum(n)]), which), n[which]


def split_ids(ids: np.ndarray, per_part: np.ndarray, begin: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """The ids of each text, whose parts are those that begin in first[i]:first[i + 1]."""
    ends = np.concatenate([[0], np.cumsum(per_part)])[np.searchsorted(begin, first)]
    return [ids[a:b] for a, b in zip(ends, ends[1:])]
