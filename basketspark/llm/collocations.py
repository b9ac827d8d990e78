"""Phrase collocation mining over broadcast double-array tries (operator 12).

Texts (A-Z lower-cased) are split at punctuation and line ends into pieces and those at blanks
into words. Everything is counted per language.

1. Level by level (1 to ``max_words`` words) each task counts 64-bit hashes of the phrases at all
   places of its texts; the counts are summed by ranges of hashes. A place takes part in a level only if both phrases that
   are one word shorter may be frequent (the Apriori rule), which a bitmap of the hashes that
   reached ``min_count`` tells. Equal hashes or bits of different phrases only let more through,
   so no frequent phrase is lost.
2. The phrases themselves at the places that are left are the candidates, each once (what a task
   gave lately is told by 128 bits).
3. Candidates are dealt by a hash of their first word's first bytes to shards of about ``SHARD_BYTES`` of text (a
   hash with more phrases than that is split further). A shard becomes a double-array trie
   over bytes in one task, the ends that only one phrase has as plain bytes behind it, and is
   broadcast; every task starts at the root of its language at all words of a chunk whose hash is
   the shard's, advances all states by one byte a step with numpy, drops those without a
   transition, and bincounts the accepting states that end a word. Spark sums the counts of all
   chunks. These counts are exact: bytes are compared, not hashes.

The bitmap is bounded by ``MOST_BITS``, a shard by ``SHARD_BYTES``; more candidates mean more
shards, one after another, never larger ones. Scores are exact in 38-digit decimals.

Defined cases: a null text is empty; a null language is ``und``; empty texts and pieces have no
words; texts of any length are counted whole; repeated rows and ids count again; of equal scores
the larger count, then the first phrase in byte order is ranked first; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketspark.llm.text import head_keys, joined_keys, mix, pinned, range_keys, renamed, slices

UNKNOWN = "und"
#: Text bytes of the candidates in one shard, about, and bits of the largest bitmap.
SHARD_BYTES = 12 << 20
MOST_BITS = 1 << 30
_LEAST_BITS, _BLOCK_BITS, _BITS_EACH = 1 << 22, 1 << 18, 64
#: Hashes that a task puts together before it sums them, hashes that it holds at most before it sends
#: them, and ranges of hashes a shuffle partition.
_TALLY, _SENT, _RANGES = 1 << 19, 1 << 20, 8
_SPACE, _BREAK = 32, 10
_SEPARATORS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")


# --- words of a chunk of texts ---


class Chunk:
    """Texts of one language as bytes with single blanks, and where their words are."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(t.lower().translate(_SEPARATORS) for t in texts) + b"\n"  # bytes.lower() changes A-Z only
        data = np.frombuffer(joined, np.uint8)
        blank = data == _SPACE
        data = np.delete(data, np.flatnonzero(blank[1:] & blank[:-1]))
        gap = (data == _SPACE) | (data == _BREAK)
        edge = np.flatnonzero(np.diff(gap, prepend=True))
        self.data, self.begin, self.end = data, edge[::2], edge[1::2]
        self.piece = np.cumsum(data == _BREAK, dtype=np.int32)[self.begin]
        self.own: list[np.ndarray] = []
        self.made: dict[tuple[int, int], np.ndarray] = {}

    def phrases(self, words: int) -> np.ndarray:
        """Numbers of the words at which a phrase of so many words of one piece begins."""
        n = len(self.begin) - words + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[:n] == self.piece[words - 1 :][:n])

    def words(self, lane: int = 0) -> np.ndarray:
        """A hash of each word, worked out once."""
        if len(self.own) <= lane:  # both are made if the second is asked for
            self.own = range_keys(self.data, self.begin, self.end, lane + 1)
        return self.own[lane]

    def heads(self) -> np.ndarray:
        """A hash of the first bytes of each word, by which phrases are dealt to shards."""
        return head_keys(self.data, self.begin, self.end)

    def hashes(self, lang: str, words: int, lane: int = 0) -> np.ndarray:
        """A hash of the phrase of so many words at each word (whatever follows a piece's end),
        worked out once, from those of one word less."""
        if (words, lane) not in self.made:
            own = self.words(lane)
            if words == 1:
                h = mix(own ^ np.uint64(int.from_bytes(lang.encode()[:8].ljust(8), "little")))
            else:
                n = max(0, len(own) - words + 1)
                h = joined_keys(self.hashes(lang, words - 1, lane)[:n], own[words - 1 :], lane)
            self.made[words, lane] = h
        return self.made[words, lane]

    def texts(self, at: np.ndarray, words: int) -> pa.Array:
        """The phrases of so many words at some words, copied as one run of bytes."""
        begin, size = self.begin[at], self.end[at + words - 1] - self.begin[at]
        place = np.concatenate([[0], np.cumsum(size)])
        raw = self.data[np.arange(place[-1]) + np.repeat(begin - place[:-1], size)]
        return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(place.astype(np.int32)), pa.py_buffer(raw)])


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, Chunk]]:
    langs = np.array(batch.column("lang").to_pylist(), object)
    for lang in sorted(set(langs.tolist())):
        part = batch.filter(pa.array(langs == lang))
        for _, _, texts in slices(part, "text"):
            yield lang, Chunk(texts)


# --- bitmaps of the hashes that are frequent enough ---


class Bitmap:
    """Which hashes may be frequent: one bit for the first bits of each."""

    def __init__(self, bits: int, blocks: dict[int, bytes]):
        self.shift = np.uint64(64 - (bits.bit_length() - 1))
        self.held = np.zeros(bits // 8, np.uint8)
        size = _BLOCK_BITS // 8
        for block, raw in blocks.items():
            self.held[block * size : (block + 1) * size] = np.frombuffer(raw, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        bit = (hashes >> self.shift).astype(np.int64)
        return (self.held[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def _bits_of(frame: pd.DataFrame) -> pd.DataFrame:
    marks = np.zeros(_BLOCK_BITS, np.uint8)
    marks[frame["bit"].to_numpy()] = 1
    return pd.DataFrame({"block": frame["block"].iloc[:1], "raw": [np.packbits(marks, bitorder="little").tobytes()]})


def bitmap_of(hashes: DataFrame) -> Bitmap:
    """The bitmap of a column ``h`` of distinct hashes. Its blocks are made by Spark; the driver
    holds the bitmap only, of ``MOST_BITS`` bits at most."""
    n = hashes.count()
    bits = min(MOST_BITS, max(_LEAST_BITS, 1 << (n * _BITS_EACH).bit_length()))
    at = F.shiftrightunsigned("h", 64 - (bits.bit_length() - 1))
    block_shift = _BLOCK_BITS.bit_length() - 1
    placed = hashes.select(F.shiftright(at, block_shift).cast("int").alias("block"), at.bitwiseAND(F.lit(_BLOCK_BITS - 1)).cast("int").alias("bit"))
    rows = placed.distinct().groupBy("block").applyInPandas(_bits_of, "block int, raw binary").toLocalIterator()
    return Bitmap(bits, {r["block"]: bytes(r["raw"]) for r in rows})


def _able(chunk: Chunk, lang: str, words: int, maps: list[Bitmap]) -> np.ndarray:
    """Beginnings of the phrases of so many words whose shorter phrases may all be frequent."""
    at = chunk.phrases(words)
    if words > 1 and len(at):
        shorter = maps[words - 2].has(chunk.hashes(lang, words - 1))
        at = at[shorter[at] & shorter[at + 1]]
    return at


class _Tally:
    """Hashes and how often each occurs, put together batch by batch."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.least = 0

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.held.append((hashes, counts))
        self.size += len(hashes)
        if self.size > max(_TALLY, 2 * self.least):  # as one again, once it has doubled
            self.held = [self.summed()]
            self.size = self.least = len(self.held[0][0])

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct hashes in order, count of each)."""
        h, n = (np.concatenate([np.zeros(0, t), *(x[i] for x in self.held)]) for i, t in enumerate((np.uint64, np.int64)))
        order = np.argsort(h)
        h, n = h[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        return h[first], np.add.reduceat(n, first) if len(h) else n


def _hash_counts(texts: DataFrame, words: int, maps: list, min_count: int) -> DataFrame:
    """(lang, h, n): how often each hash of a phrase of so many words (and its language) occurs, if
    ``min_count`` times or more, lang being null; and for single words, h being null, the words of
    each language in all.

    A task deals its hashes to ranges of their values, as arrays, so that what Spark shuffles is a row
    a range and not a row a hash; the ranges grow in number with the session's shuffle partitions.
    """
    ranges = _RANGES * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = ["lang", "at", "h", "n"]

    def dealt(tally: _Tally) -> Iterator[pa.RecordBatch]:
        h, n = tally.summed()
        ends = np.searchsorted(h, _range_begins(ranges))
        cuts = [(i, a, b) for i, (a, b) in enumerate(zip(ends.tolist(), [*ends[1:].tolist(), len(h)])) if a < b]
        columns = [pa.array([x[a:b].tobytes() for _, a, b in cuts], pa.binary()) for x in (h, n)]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(cuts), pa.string()), pa.array([i for i, _, _ in cuts], pa.int32()), *columns], names=names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [m.value for m in maps]
        tally, totals = _Tally(), Counter()
        for batch in batches:
            for lang, chunk in _by_language(batch):
                tally.add(*np.unique(chunk.hashes(lang, words)[_able(chunk, lang, words, known)], return_counts=True))
                totals[lang] += len(chunk.begin)
            if tally.size > _SENT:
                yield from dealt(tally)
                tally = _Tally()
        yield from dealt(tally)
        if words == 1:
            some = {lang: n for lang, n in totals.items() if n}
            columns = [pa.nulls(len(some), pa.binary()), pa.array([np.int64(n).tobytes() for n in some.values()], pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(list(some), pa.string()), pa.array([-1] * len(some), pa.int32()), *columns], names=names)

    def summed(table: pa.Table) -> pa.Table:
        h, n = ([np.frombuffer(x, t) for x in table[c].to_pylist() if x is not None] for c, t in (("h", np.uint64), ("n", np.int64)))
        if table["at"][0].as_py() < 0:
            totals: Counter = Counter()
            for lang, count in zip(table["lang"].to_pylist(), n):
                totals[lang] += int(count[0])
            columns = [pa.array(list(totals), pa.string()), pa.nulls(len(totals), pa.int64()), pa.array(list(totals.values()), pa.int64())]
        else:
            tally = _Tally()
            tally.held = list(zip(h, n))
            h, n = tally.summed()
            h, n = h[n >= min_count], n[n >= min_count]
            columns = [pa.nulls(len(h), pa.string()), pa.array(h.view(np.int64)), pa.array(n)]
        return pa.Table.from_arrays(columns, names=["lang", "h", "n"])

    return texts.mapInArrow(rows, "lang string, at int, h binary, n binary").groupBy("at").applyInArrow(summed, "lang string, h long, n long")


def _range_begins(ranges: int) -> np.ndarray:
    """Where each of so many ranges of 64-bit hashes begins."""
    return np.array([(i << 64) // ranges for i in range(ranges)], np.uint64)


class Given:
    """The phrases that a task has given lately, by 128 bits each. A phrase takes the place of the
    one before it there, which at worst is given again."""

    def __init__(self, slots: int = 1 << 21):
        self.a, self.b = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)

    def others(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where phrases stand that were not given lately, each once; they count as given now."""
        slot = (a & np.uint64(len(self.a) - 1)).astype(np.int64)
        new = np.flatnonzero((self.a[slot] != a) | (self.b[slot] != b))
        new = new[np.argsort(a[new])]
        if len(new):
            own, other = a[new], b[new]
            new = new[np.concatenate([[True], (own[1:] != own[:-1]) | (other[1:] != other[:-1])])]
        self.a[slot[new]], self.b[slot[new]] = a[new], b[new]
        return new


def _candidates(texts: DataFrame, maps: list) -> DataFrame:
    """(lang, words, first, phrase: binary): the distinct phrases that may be frequent, first being
    a hash of the first bytes of the first word."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [m.value for m in maps]
        given = Given()
        for batch in batches:
            for lang, chunk in _by_language(batch):
                chunk.words(1)
                own, heads = np.uint64(xxhash.xxh64_intdigest(lang)), chunk.heads().view(np.int64)
                for words, able in enumerate(known, 1):
                    at = _able(chunk, lang, words, known)
                    at = at[able.has(chunk.hashes(lang, words)[at])]
                    at = at[given.others(chunk.hashes(lang, words)[at] ^ own, chunk.hashes(lang, words, 1)[at])]
                    columns = [pa.array([lang] * len(at), pa.string()), pa.array(np.full(len(at), words), pa.int32()), pa.array(heads[at])]
                    yield pa.RecordBatch.from_arrays([*columns, chunk.texts(at, words)], names=["lang", "words", "first", "phrase"])

    return texts.mapInArrow(rows, "lang string, words int, first long, phrase binary").distinct()


# --- double-array tries ---


class Trie:
    """Phrases as bytes: the child of state s by byte c is base[s] + c if check there says s.
    ``accept`` has the number of the phrase that ends at a state. Where one phrase only is left,
    its number is in ``alone`` and its other bytes are compared with ``text``, in which all phrases
    stand one after another, phrase n from ``place[n]`` on."""

    def __init__(self, base: np.ndarray, check: np.ndarray, accept: np.ndarray, alone: np.ndarray, depth: np.ndarray, phrases: list[bytes], roots: dict[str, int]):
        self.base, self.check, self.accept, self.alone, self.depth, self.roots = base, check, accept, alone, depth, roots
        self.count = len(phrases)
        self.text = np.frombuffer(b"\n".join(phrases) + b"\n", np.uint8)  # a break ends a phrase
        self.place = np.concatenate([[0], np.cumsum([len(p) + 1 for p in phrases])[:-1]]).astype(np.int32)

    def counts(self, lang: str, chunk: Chunk, at: np.ndarray) -> np.ndarray:
        """Occurrences of each phrase at the words beginning at ``at``: all of them advance
        together, byte by byte."""
        if lang not in self.roots:
            return np.zeros(self.count, np.int64)
        met = []  # numbers of the phrases that ended, step by step
        state = np.full(len(at), self.roots[lang], np.int32)
        gap = (chunk.data == _SPACE) | (chunk.data == _BREAK)
        last = len(self.check) - 1
        number, byte, place = (np.zeros(0, np.int32) for _ in range(3))  # of phrases that are alone
        while len(at) or len(place):
            if len(at):
                single = self.alone[state]
                on = np.flatnonzero(single >= 0)
                if len(on):
                    n = single[on]
                    number, place = np.concatenate([number, n]), np.concatenate([place, at[on].astype(np.int32)])
                    byte = np.concatenate([byte, self.place[n] + self.depth[state[on]]])
                    on = np.flatnonzero(single < 0)
                    state, at = state[on], at[on]
                to = np.minimum(self.base[state] + chunk.data[at], last)
                on = np.flatnonzero(self.check[to] == state)
                state, at = to[on], at[on] + 1
                ended = gap[at]  # a text ends with a break
                met.append(self.accept[state[ended]])
            if len(place):
                wanted = self.text[byte]
                done = wanted == _BREAK
                met.append(number[done & gap[place]])
                on = np.flatnonzero(~done & (wanted == chunk.data[place]))
                number, byte, place = number[on], byte[on] + 1, place[on] + 1
            # A break has no transition, and nothing is read beyond the last one.
        return np.bincount(np.concatenate([np.zeros(0, np.int32), *met]), minlength=self.count + 1)[:-1]


_TRIES = 16  # places looked at for a state's children before they are put behind all others


def build_trie(langs: list[str], phrases: list[bytes]) -> Trie:
    """The trie of phrases sorted by language and bytes, breadth first."""
    # Flat arrays, not objects a state: a shard has millions of states.
    roots: dict[str, int] = {}
    used, base, check = bytearray(1), array("i", [0]), array("i", [-1])
    ends, alone = (array("i"), array("i")), (array("i"), array("i"), array("i"))  # states, phrases, bytes read

    def room(size: int) -> None:
        if size > len(used):
            more = max(size, len(used) + len(used) // 2) - len(used)
            used.extend(bytes(more))
            base.frombytes(bytes(4 * more))
            check.frombytes(b"\xff" * (4 * more))

    def note(lists: tuple[array, ...], *values: int) -> None:
        for one, value in zip(lists, values):
            one.append(value)

    level = array("i"), array("i"), array("i")  # states, and the first and last phrase of each
    free = 1
    begin = 0
    for lang in sorted(set(langs)):
        end = begin + langs.count(lang)
        room(free + 1)
        used[free], check[free] = 1, -2
        roots[lang] = free
        note(level, free, begin, end)
        begin, free = end, free + 1
    wide = top = free
    depth = 0
    while level[0]:
        after = array("i"), array("i"), array("i")
        for state, lo, hi in zip(*level):
            if len(phrases[lo]) == depth:
                note(ends, state, lo)
                lo += 1
            if lo == hi:
                continue
            children, cuts, i = [], [], lo
            while i < hi:  # phrases are sorted, so those of one child follow each other
                c = phrases[i][depth]
                children.append(c)
                cuts.append(i)
                if phrases[hi - 1][depth] == c:
                    break
                step, j = 1, i
                while j + step < hi and phrases[j + step][depth] == c:
                    j, step = j + step, step * 2
                while step:
                    if j + step < hi and phrases[j + step][depth] == c:
                        j += step
                    else:
                        step //= 2
                i = j + 1
            cuts.append(hi)
            # One child fills the first hole; several are put where there is most room.
            least, several = children[0], len(children) > 1
            place = max(wide if several else free, least)
            for _ in range(_TRIES):
                room(place + 257)
                place = used.find(0, place)
                if place < 0:
                    place = len(used)
                    room(place + 257)
                if not any(used[place + c - least] for c in children):
                    break
                place += 1
            else:
                place = max(top, least)
                room(place + 257)
            at = place - least
            if several:
                wide = place + 1
            elif place == free or place < least + _TRIES:
                free = max(free, used.find(0, free))
            top = max(top, at + children[-1] + 1)
            base[state] = at
            for c, a, b in zip(children, cuts, cuts[1:]):
                used[at + c], check[at + c] = 1, state
                if b - a == 1:
                    note(alone, at + c, a, depth + 1)
                else:
                    note(after, at + c, a, b)
        level = after
        depth += 1
    del used
    size = top + 1
    flat = lambda a: np.frombuffer(a, np.int32) if len(a) else np.zeros(0, np.int32)
    accept = np.full(size, len(phrases), np.int32)  # counted there and thrown away
    accept[flat(ends[0])] = flat(ends[1])
    alone_a, depth_a = np.full(size, -1, np.int32), np.zeros(size, np.int32)
    alone_a[flat(alone[0])] = flat(alone[1])
    depth_a[flat(alone[0])] = flat(alone[2])
    return Trie(flat(base)[:size], flat(check)[:size], accept, alone_a, depth_a, phrases, roots)


_ARRAYS = ("base", "check", "accept", "alone", "depth")


def _shard_rows(frame: pd.DataFrame) -> pd.DataFrame:
    """One shard's trie. The phrases' numbers are their positions in the order of language, bytes."""
    order = sorted(zip(frame["lang"], map(bytes, frame["phrase"])))
    trie = build_trie([x[0] for x in order], [x[1] for x in order])
    cells = {c: [getattr(trie, c).tobytes()] for c in _ARRAYS}
    roots = ",".join(f"{lang.encode().hex()}:{state}" for lang, state in trie.roots.items())
    return pd.DataFrame({"part": frame["part"].iloc[:1], "shard": frame["shard"].iloc[:1], **cells, "phrases": [trie.text.tobytes()], "roots": [roots]})


def _trie_of(row) -> Trie:
    roots = {bytes.fromhex(a).decode(): int(b) for a, b in (x.split(":") for x in row["roots"].split(","))}
    arrays = [np.frombuffer(bytes(row[c]), np.int32) for c in _ARRAYS]
    return Trie(*arrays, bytes(row["phrases"])[:-1].split(b"\n"), roots)


def _shard_counts(texts: DataFrame, part: int, parts: int, shard: int, trie) -> DataFrame:
    """(shard, number, n) of the phrases of one shard, per batch."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = trie.value
        for batch in batches:
            total = np.zeros(known.count, np.int64)
            for lang, chunk in _by_language(batch):
                at = chunk.begin if parts == 1 else chunk.begin[(chunk.heads() >> np.uint64(1)) % np.uint64(parts) == part]
                total += known.counts(lang, chunk, at)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), shard), pa.int32()), pa.array(some.astype(np.int32)), pa.array(total[some])], names=["shard", "number", "n"])

    return texts.mapInArrow(rows, "shard int, number int, n long")


def phrase_counts(docs: DataFrame, max_words: int = 3, min_count: int = 10, lang="lang", text="text") -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of all phrases of 1 to max_words words that occur min_count times
    or more, and (lang, n): words in all. Written once."""
    spark = docs.sparkSession
    src = renamed(docs, {lang: "lang", text: "text"})
    src = src.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("binary").alias("text"))
    maps = []
    for words in range(1, max_words + 1):
        frequent = pinned(_hash_counts(src, words, maps, min_count), "frequent-hashes")
        if words == 1:
            totals = frequent.where("lang IS NOT NULL").select("lang", "n")
        maps.append(spark.sparkContext.broadcast(bitmap_of(frequent.where("lang IS NULL").select("h"))))
    found = pinned(_candidates(src, maps), "phrase-candidates")
    size = found.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    parts = max(1, -(-size // SHARD_BYTES))  # parts of the first words
    # A part that some first words make larger is several shards.
    part = F.pmod(F.shiftrightunsigned("first", 1), F.lit(parts)).cast("int").alias("part")
    placed = found.select("lang", "words", "phrase", part)
    each = placed.groupBy("part").agg(F.ceil(F.sum(F.octet_length("phrase")) / F.lit(2 * SHARD_BYTES)).cast("int").alias("pieces"))
    many = {r["part"]: r["pieces"] for r in each.where("pieces > 1").collect()}  # at most as many as shards
    pieces = F.coalesce(F.create_map(*[F.lit(x) for kv in many.items() for x in kv])[F.col("part")], F.lit(1)) if many else F.lit(1)
    first = np.concatenate([[0], np.cumsum([many.get(p, 1) for p in range(parts)])]).tolist()
    begins = F.lit(0) if not many else F.element_at(F.array(*map(F.lit, first)), F.col("part") + 1)
    number = F.col("part") if not many else begins + F.pmod(F.xxhash64("phrase"), pieces)
    dealt = placed.select("lang", "words", "phrase", "part", number.cast("int").alias("shard"))
    schema = "part int, shard int, " + ", ".join(f"{c} binary" for c in (*_ARRAYS, "phrases")) + ", roots string"
    tries = pinned(dealt.groupBy("shard").applyInPandas(_shard_rows, schema), "tries") if size else None
    counted = None
    for shard in range(first[-1] if size else 0):
        row = tries.where(F.col("shard") == shard).first()  # one shard: bounded
        if row is None:
            continue
        sent = spark.sparkContext.broadcast(_trie_of(row))
        sums = _shard_counts(src, row["part"], parts, shard, sent).groupBy("shard", "number").agg(F.sum("n").alias("f"))
        some = pinned(sums.where(F.col("f") >= min_count), "shard-counts")
        sent.destroy()
        counted = some if counted is None else counted.unionByName(some)
    for m in maps:
        m.destroy()
    if counted is None:
        counted = spark.createDataFrame([], "shard int, number int, f long")
    numbered = dealt.groupBy("shard").applyInPandas(_number_rows, "shard int, number int, lang string, words int, phrase string")
    return pinned(numbered.join(counted, ["shard", "number"]).select("lang", "words", "phrase", "f"), "phrase-counts"), totals


def _number_rows(frame: pd.DataFrame) -> pd.DataFrame:
    out = frame.sort_values(["lang", "phrase"], ignore_index=True)
    return pd.DataFrame({"shard": out["shard"], "number": np.arange(len(out), dtype=np.int32), "lang": out["lang"], "words": out["words"], "phrase": [bytes(p).decode() for p in out["phrase"]]})


# --- scores ---


def score_phrases(counts: DataFrame) -> DataFrame:
    """(lang, words, phrase, a, l, r, score) of the phrases of two words or more: of all cuts into
    a first part and a rest the one with the lowest floor(10^6 a^2 / (l r)), then the first."""
    parts = F.split("phrase", " ")
    joined = lambda begin, n: F.array_join(F.slice(parts, begin, n), " ")
    cuts = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(k.alias("k"), joined(F.lit(1), k).alias("left"), joined(k + 1, F.col("words") - k).alias("right")))
    each = counts.where("words >= 2").select("lang", "words", "phrase", F.col("f").alias("a"), F.explode(cuts).alias("c")).select("*", "c.*").drop("c")
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    met = each.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    # The quotient's digits are cut off, so it is taken by whole numbers: a * 10^6 fits 38 digits.
    product = (wide("a") * wide("a")).cast("decimal(32,0)") * F.lit(1000000).cast("decimal(7,0)")
    score = met.withColumn("p", product.cast("decimal(38,0)")).withColumn("q", (wide("l") * wide("r")).cast("decimal(38,0)"))
    score = score.withColumn("score", F.expr("p div q"))
    best = score.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return best.select("lang", "words", "phrase", "a", "m.l", "m.r", "m.score")


def drop_covered(scored: DataFrame, covered_percent: int) -> DataFrame:
    """Without the phrases that lie inside a longer one which occurs at least that part as often."""
    parts = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: F.array_join(F.slice(parts, i, n), " "))))
    longer = scored.where("words >= 3").select("lang", F.col("a").alias("longer"), F.explode(F.array_distinct(inner)).alias("phrase"))
    most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(most, ["lang", "phrase"], "left")
    return kept.where(F.col("longer").isNull() | (100 * F.col("longer") < covered_percent * F.col("a"))).drop("longer")


def mine_phrases(docs: DataFrame, max_words: int = 3, min_count: int = 10, covered_percent: int = 50, top: int = 2000, lang="lang", text="text") -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank (from 1), phrase, a (occurrences),
    l and r (of the parts of the weakest cut), n (words of the language), score."""
    counts, totals = phrase_counts(docs, max_words, min_count, lang, text)
    scored = pinned(score_phrases(counts), "scored-phrases")
    kept = drop_covered(scored, covered_percent)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # The first of each part of a language, then of all parts, so that no task ranks a whole one.
    salted = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    named = ranked.join(totals, "lang")
    return named.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
