"""Conversation structure repair by a grammar-compressed dynamic programme (operator 11).

A conversation should run ``(s?(ua)+)?``: maybe a system turn, then user and assistant in turn.
Its rows become symbols (role initial and fault), and the cheapest edits are a product of 4 x 4
min-plus transfer matrices over the places of that pattern, one matrix per symbol. An entry holds
the least cost and, of equal costs, the ASCII-least audit. Audits of equal cost between the same
rows are never prefixes of each other (one more insertion costs more), so the smaller one stays
smaller whatever follows, and matrices may be multiplied in any grouping.

* Rows are range-partitioned and sorted by conversation, turn, role and text; each task cuts its
  rows into segments of at most ``SEGMENT_ROWS`` rows or ``SEGMENT_BYTES``, so a conversation that
  holds a third of all rows is many segments over many tasks. Texts stay in the segments.
* Equal (role, text) pairs are met by 128-bit hashes: inside a segment at once, between the
  segments of a cut conversation by an aggregation.
* Distinct symbol sequences are compressed by Re-Pair (the most frequent pair becomes a rule, until
  none repeats), a batch of sequences sharing its rules; a rule's matrix is the product of its two
  symbols' matrices, bottom-up, and its audits are ropes that share their parts. A sequence's
  matrix is worked out once and joined to all segments that have it.
* Segments of a cut conversation are multiplied in order, holding one row of the matrix. The
  repaired text is hashed as a stream, segment by segment: a SHA-256 has one order only, so a cut
  conversation's hash is one task's work, in bounded memory; its audit is one cell by contract.

Defined cases: null roles and texts are one space; null conversation ids are one conversation;
null turns come first; rows of one turn are taken by role, then text; repeated rows are duplicates
of the first; other initials than s, u and a fit nowhere and are given a role or deleted; empty
and very long texts are rows like others; an empty table gives an empty result; other columns are
ignored. Without rows a conversation has zeros, an empty audit and the hash of an empty text.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketspark.llm.text import package_path, pinned

SEGMENT_ROWS = 8192
SEGMENT_BYTES = 4 << 20
#: Symbols that one run of Re-Pair works on at a time (one sequence at least), and its rules at most.
GRAMMAR_SYMBOLS = 100_000
GRAMMAR_RULES = 512

#: The costs of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Places in the pattern: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: Symbols: role initial (o: any other), in capitals where truncated; b blank, d duplicate.
SYMBOLS = "suaoSUAObd"
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_NAME = {USER: "user", ASSISTANT: "assistant"}
_LETTERS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


# --- audits as ropes, and matrices of {(from, to): (cost, audit)} ---


def _leaves(rope) -> Iterator[str]:
    todo = [rope]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            yield x
        else:
            todo += [x[1], x[0]]


def rope_text(rope) -> str:
    return "".join(_leaves(rope))


def _less(a, b) -> bool:
    """Whether rope a is before rope b; neither is a prefix of the other unless they're equal."""
    while isinstance(a, tuple) and isinstance(b, tuple) and a[0] is b[0]:  # a shared beginning
        a, b = a[1], b[1]
    if a is b:
        return False
    one, two, x, y = _leaves(a), _leaves(b), "", ""
    while True:
        x, y = x or next(one, ""), y or next(two, "")
        if not x or not y:
            return not x and bool(y)
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


def _joined(a, b):
    if not a or not b:
        return a or b
    return a + b if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 64 else (a, b)


def _better(out: dict, key, cost: int, rope) -> None:
    known = out.get(key)
    if known is None or cost < known[0] or cost == known[0] and _less(rope, known[1]):
        out[key] = cost, rope


def product(a: dict, b: dict) -> dict:
    """The matrix of a, then b."""
    out: dict = {}
    for (i, k), (c, x) in a.items():
        for j in range(4):
            if (k, j) in b:
                d, y = b[k, j]
                known = out.get((i, j))
                if known is None or c + d <= known[0]:
                    _better(out, (i, j), c + d, _joined(x, y))
    return out


def _insertions() -> dict:
    out = {}
    for i in range(4):
        at, cost, audit = i, 0, ""
        while (i, at) not in out:
            out[i, at] = cost, audit
            at, cost, audit = _NEXT[at], cost + INSERT, audit + "I"
    return out


INSERTIONS = _insertions()


def symbol_matrix(symbol: str) -> dict:
    """Any insertions, then what may become of one row."""
    out = {(i, i): (DELETE, "D") for i in range(4)}
    if symbol not in "bd":
        extra = TRUNCATED if symbol.isupper() else 0
        own = _LETTERS.get(symbol.lower())
        for i in range(4):
            _better(out, (i, _NEXT[i]), REROLE + extra, "R")
            if own is not None and (own == _NEXT[i] or own == SYSTEM and i == START):
                _better(out, (i, own), KEEP + extra, "K")
    return product(INSERTIONS, out)


# --- Re-Pair ---


def _numbered(starts: np.ndarray) -> np.ndarray:
    """Of True values in a row, how many precede each."""
    at = np.arange(len(starts))
    return at - np.maximum.accumulate(np.where(starts, -1, at))


def replace_pair(seq: np.ndarray, a: int, b: int, new: int) -> np.ndarray:
    """The sequence with the occurrences of a, b, from the left, replaced by the new symbol."""
    hit = np.append((seq[:-1] == a) & (seq[1:] == b), False)
    if a == b:  # of a run every other pair
        hit &= _numbered(hit) % 2 == 1
    out = np.where(hit, new, seq)
    return out[~np.concatenate([[False], hit[:-1]])]


def re_pair(sequences: list[str], most_rules: int = GRAMMAR_RULES) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """(the sequences in symbols of the grammar, its rules as pairs). Symbol n < len(SYMBOLS) is a
    letter, the others are rules in their order."""
    letters = np.zeros(256, np.int32)
    letters[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(len(SYMBOLS))
    joined = np.frombuffer("\n".join(sequences).encode(), np.uint8)
    seq = np.where(joined == 10, -1, letters[joined])
    rules: list[tuple[int, int]] = []
    while len(rules) < most_rules:
        size = len(SYMBOLS) + len(rules)
        inside = (seq[:-1] >= 0) & (seq[1:] >= 0)
        keys = seq[:-1][inside].astype(np.int64) * size + seq[1:][inside]
        if not len(keys):
            break
        counts = np.bincount(keys, minlength=1)
        best = int(counts.argmax())
        if counts[best] < 2:
            break
        rules.append((best // size, best % size))
        seq = replace_pair(seq, *rules[-1], size)
    return np.split(seq, np.flatnonzero(seq < 0)), rules


def sequence_matrices(sequences: list[str], most_rules: int = GRAMMAR_RULES) -> list[dict]:
    """The matrix of each symbol sequence, by one grammar for all of them."""
    coded, rules = re_pair(sequences, most_rules)
    known = [symbol_matrix(s) for s in SYMBOLS]
    for a, b in rules:
        known.append(product(known[a], known[b]))
    out = []
    for seq in coded:
        total = {(i, i): (0, "") for i in range(4)}
        for s in seq.tolist():
            if s >= 0:
                total = product(total, known[s])
        out.append(total)
    return out


# --- segments ---

_SEGMENT = (
    "part int, no long, edge boolean, symbols string, roles array<string>, texts array<string>, keys binary, "
    "first_turn long, last_turn long, turns long, low long, high long, first_role string, last_role string, illegal long"
)
_BLANK = " \t\n\x0b\x0c\r"


def _initial(role: str) -> str:
    return role[:1]


def _symbol(role: str, text: str, seen: bool) -> str:
    shown = text.rstrip(_BLANK)
    if not shown:
        return "b"
    if seen:
        return "d"
    letter = _initial(role) if _initial(role) in _LETTERS else "o"
    return letter if shown[-1] in ".!?" else letter.upper()


class _Segment:
    def __init__(self, conv, first_no: int):
        self.conv, self.no, self.seen = conv, first_no, set()
        self.clear()

    def clear(self) -> None:
        self.symbols, self.roles, self.texts, self.keys, self.turns, self.size = [], [], [], [], [], 0

    def add(self, turn, role: str, text: str) -> None:
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        self.symbols.append(_symbol(role, text, key in self.seen))
        self.seen.add(key)
        self.roles.append(role)
        self.texts.append(text)
        self.keys.append(key)
        self.turns.append(turn)
        self.size += len(role) + len(text)

    def full(self) -> bool:
        return len(self.roles) >= SEGMENT_ROWS or self.size >= SEGMENT_BYTES

    def values(self, part: int, edge: bool) -> tuple:
        known = [t for t in self.turns if t is not None]
        distinct = sum(a != b for a, b in zip([None, *known], known))
        letters = [_initial(r) for r in self.roles]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(letters, letters[1:]))
        ends = (known[0], known[-1]) if known else (None, None)
        return (
            self.conv, part, self.no, edge, "".join(self.symbols), self.roles, self.texts, b"".join(self.keys) if edge else None,
            *ends, distinct, *ends, letters[0], letters[-1], illegal,
        )


def _cut(record):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: _Segment | None = None
        # Whether the held conversation may have rows in other segments: it's the partition's
        # first one (or its last, below), or has been cut.
        split, no, out, size, typed = True, 0, [], 0, None
        for batch in batches:
            typed = batch.column("conv").type
            columns = [batch.column(c) for c in ("conv", "turn", "role", "text")]
            for i in range(batch.num_rows):
                conv, turn, role, text = (c[i].as_py() for c in columns)
                if held and (conv != held.conv or held.full()):
                    cut = conv == held.conv
                    out.append(held.values(part, split or cut))
                    size += held.size + 1000
                    no += 1
                    split = cut
                    held = None
                    if size >= SEGMENT_BYTES:
                        yield record(out, typed)
                        out, size = [], 0
                held = held or _Segment(conv, no)
                held.add(turn, role, text)
        if held:
            out.append(held.values(part, True))
            yield record(out, typed)

    return rows


def _segments(src: DataFrame, kind: str) -> DataFrame:
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first()]
    # Sampled sort keys go to the driver: of the rows of one turn only their first characters.
    begin = F.substring(F.concat_ws("\x00", "role", "text"), 1, 64)
    ranged = src.repartitionByRange(*order, begin).sortWithinPartitions(*order, "role", "text")
    names = ["conv", *[f.split()[0] for f in _SEGMENT.split(", ")]]
    types = [
        pa.int32(), pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.binary(),
        *[pa.int64()] * 5, pa.string(), pa.string(), pa.int64(),
    ]

    record = lambda out, typed: _record(out, names, [typed, *types])
    return pinned(ranged.mapInArrow(_cut(record), f"conv {kind}, {_SEGMENT}"), "conversation-segments")


def _late_duplicates(edges: DataFrame, kind: str) -> DataFrame:
    """(part, no, late): places in segments of cut conversations whose (role, text) an earlier
    segment has."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw, symbols = batch.column("keys")[i].as_py(), batch.column("symbols")[i].as_py()
                at = [j for j, s in enumerate(symbols) if s not in "bd"]
                if at:
                    pair = np.frombuffer(raw, np.int64).reshape(-1, 2)[at]
                    own = [pa.array([batch.column(c)[i].as_py()] * len(at), batch.column(c).type) for c in ("conv", "part", "no")]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(at, pa.int32()), pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["conv", "part", "no", "at", "h1", "h2"])

    keys = edges.select("conv", "part", "no", "keys", "symbols").mapInArrow(rows, f"conv {kind}, part int, no long, at int, h1 long, h2 long")
    keys = keys.withColumn("place", F.struct("part", "no"))
    firsts = keys.groupBy(F.col("conv").alias("c"), F.col("h1").alias("a"), F.col("h2").alias("b")).agg(F.min("place").alias("first"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b"))
    late = keys.join(firsts, same).where(F.col("place") != F.col("first"))
    return late.groupBy("part", "no").agg(F.collect_set("at").alias("late"))  # a segment's rows at most


def _edges(segments: DataFrame, kind: str) -> DataFrame:
    """The narrow columns of the segments of cut conversations, the symbols with the duplicates
    of earlier segments."""
    edges = segments.where("edge")
    late = _late_duplicates(edges, kind)
    marked = F.array_join(F.transform(F.split("symbols", ""), lambda s, i: F.when(F.array_contains("late", i), F.lit("d")).otherwise(s)), "")
    joined = edges.drop("roles", "texts", "keys").join(late, ["part", "no"], "left")
    return joined.withColumn("symbols", F.when(F.col("late").isNull(), F.col("symbols")).otherwise(marked)).drop("late")


# --- matrices of the distinct sequences ---

_MATRIX = "costs array<int>, audits array<string>"


def _matrix_rows(sequences: list[str]) -> pa.RecordBatch:
    found = sequence_matrices(sequences)
    cells = [(i, j) for i in range(4) for j in range(4)]
    costs = [[m[c][0] if c in m else None for c in cells] for m in found]
    audits = [[rope_text(m[c][1]) if c in m else None for c in cells] for m in found]
    return pa.RecordBatch.from_arrays(
        [pa.array(sequences, pa.string()), pa.array(costs, pa.list_(pa.int32())), pa.array(audits, pa.list_(pa.string()))], names=["symbols", "costs", "audits"]
    )


def _matrices(symbols: DataFrame) -> DataFrame:
    """(symbols, costs, audits): the transfer matrix of each distinct sequence. Written once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for s in batch.column("symbols").to_pylist():
                if held and size + len(s) > GRAMMAR_SYMBOLS:
                    yield _matrix_rows(held)
                    held, size = [], 0
                held.append(s)
                size += len(s) + 1
            if held:
                yield _matrix_rows(held)

    return pinned(symbols.select("symbols").distinct().mapInArrow(rows, f"symbols string, {_MATRIX}"), "sequence-matrices")


# --- conversations ---

_VERDICT = "part int, no long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_VERDICT_NAMES = [f.split()[0] for f in _VERDICT.split(", ")]
_VERDICT_TYPES = [pa.int32(), *[pa.int64()] * 7, pa.string()]


class _Verdict:
    """The segments of one conversation, taken in order."""

    def __init__(self, row: dict):
        self.place = row["part"], row["no"]
        self.turns = self.illegal = 0
        self.low = self.last_turn = self.last_role = None
        self.counts: Counter = Counter()
        self.reached = {(START, START): (0, "")}

    def add(self, row: dict) -> None:
        if self.last_role is not None:
            self.illegal += self.last_role + row["first_role"] not in ("su", "ua", "au")
        self.illegal += row["illegal"]
        self.last_role = row["last_role"]
        if row["first_turn"] is not None:
            self.low = row["low"] if self.low is None else self.low
            self.turns += row["turns"] - (self.last_turn == row["first_turn"])
            self.last_turn = row["last_turn"]
        self.counts.update(row["symbols"])
        matrix = {divmod(c, 4): (cost, audit) for c, (cost, audit) in enumerate(zip(row["costs"], row["audits"])) if cost is not None}
        self.reached = product(self.reached, matrix)  # four ropes at most

    def values(self) -> tuple:
        done = product(self.reached, INSERTIONS)
        ends: dict = {}
        for end in ENDS:
            if (START, end) in done:
                _better(ends, 0, *done[START, end])
        cost, audit = ends[0]
        gaps = 0 if self.low is None else self.last_turn - self.low + 1 - self.turns
        cut = sum(n for s, n in self.counts.items() if s.isupper())
        return *self.place, gaps, self.counts["b"], self.counts["d"], cut, self.illegal, cost, rope_text(audit)


def _verdicts(rows_of: DataFrame, kind: str) -> DataFrame:
    """One row per conversation; the segments of one follow each other in one task, in order."""
    names = ["conv", *_VERDICT_NAMES]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, conv, types = None, None, []
        for batch in batches:
            types, out = [batch.column("conv").type, *_VERDICT_TYPES], []
            for i in range(batch.num_rows):
                row = _row(batch, i, batch.schema.names)
                if held is None or row["conv"] != conv:
                    if held is not None:
                        out.append((conv, *held.values()))
                    held, conv = _Verdict(row), row["conv"]
                held.add(row)
            yield _record(out, names, types)
        if held is not None:
            yield _record([(conv, *held.values())], names, types)

    return rows_of.mapInArrow(rows, f"conv {kind}, {_VERDICT}")


class _Repair:
    """Goes through the rows of a conversation and the letters of its audit together."""

    def __init__(self, conv, audit: str):
        self.conv, self.audit, self.at, self.place = conv, audit, 0, START
        self.sha, self.count = hashlib.sha256(), 0

    def rows(self, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of what becomes of the rows, with the insertions before them."""
        for role, text in zip(roles, texts):
            yield from self.insertions()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self.place = _LETTERS[_initial(role)]
                yield edit, role, text
            elif edit == "R":
                self.place = _NEXT[self.place]
                yield edit, _NAME[self.place], text

    def insertions(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.place = _NEXT[self.place]
            yield "I", _NAME[self.place], ""

    def hash(self, repaired) -> None:
        for _, role, text in repaired:
            self.sha.update((("\n" if self.count else "") + f"{role}:{text}").encode())
            self.count += 1

    def numbered(self, repaired) -> list[tuple]:
        out = [(self.conv, n, *r) for n, r in enumerate(repaired, self.count)]
        self.count += len(out)
        return out


def _row(batch: pa.RecordBatch, i: int, names) -> dict:
    return {c: batch.column(c)[i].as_py() for c in names}


def _record(out: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names=names)


def _repairs(batch: pa.RecordBatch, held: _Repair | None) -> Iterator[tuple[_Repair | None, _Repair, list, list]]:
    """(the conversation that ends before the row, the row's conversation, its roles and texts).
    A conversation begins where the row has an audit."""
    for i in range(batch.num_rows):
        row = _row(batch, i, ("conv", "audit", "roles", "texts"))
        done = None
        if row["audit"] is not None:
            done, held = held, _Repair(row["conv"], row["audit"])
        yield done, held, row["roles"], row["texts"]


def _hashes(rows_of: DataFrame, kind: str) -> DataFrame:
    """(conv, repaired_sha256) from segments in order, the first of a conversation with its audit."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, types = None, []
        for batch in batches:
            types, out = [batch.column("conv").type, pa.string()], []
            for done, held, roles, texts in _repairs(batch, held):
                if done:
                    out.append(ended(done))
                held.hash(held.rows(roles, texts))
            yield _record(out, ["conv", "repaired_sha256"], types)
        if held:
            yield _record([ended(held)], ["conv", "repaired_sha256"], types)

    def ended(x: _Repair) -> tuple:
        x.hash(x.insertions())
        return x.conv, x.sha.hexdigest()

    return rows_of.mapInArrow(rows, f"conv {kind}, repaired_sha256 string")


def _repaired(rows_of: DataFrame, kind: str) -> DataFrame:
    """(conv, position, edit, role, text) from segments in order, as ``_hashes``."""
    names = ["conv", "position", "edit", "role", "text"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, types = None, []
        for batch in batches:
            types = [batch.column("conv").type, pa.int64(), pa.string(), pa.string(), pa.string()]
            for done, held, roles, texts in _repairs(batch, held):
                out = done.numbered(done.insertions()) if done else []
                yield _record(out + held.numbered(held.rows(roles, texts)), names, types)
        if held:
            yield _record(held.numbered(held.insertions()), names, types)

    return rows_of.mapInArrow(rows, f"conv {kind}, position long, edit string, role string, text string")


def _whole(rows_of: DataFrame, kind: str) -> DataFrame:
    """Verdict, hash, roles and texts of conversations that are one segment each."""
    names = ["conv", *_VERDICT_NAMES, "repaired_sha256"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                row = _row(batch, i, batch.schema.names)
                verdict = _Verdict(row)
                verdict.add(row)
                values = verdict.values()
                repair = _Repair(row["conv"], values[-1])
                repair.hash(repair.rows(row["roles"], row["texts"]))
                repair.hash(repair.insertions())
                out.append((row["conv"], *values, repair.sha.hexdigest()))
            yield _record(out, names, [batch.column("conv").type, *_VERDICT_TYPES, pa.string()])

    return rows_of.mapInArrow(rows, f"conv {kind}, {_VERDICT}, repaired_sha256 string")


def _ordered(df: DataFrame) -> DataFrame:
    return df.repartition("conv").sortWithinPartitions("conv", "part", "no")


def _work(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame, str]:
    """(whole conversations with their matrices, segments of cut ones in order, the first with the
    audit, verdicts on the cut ones, type of the conversation id)."""
    said = lambda c, n: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n)
    src = package_path(rows).select(F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), said(role, "role"), said(text, "text"))
    kind = dict(src.dtypes)["conv"]
    segments = _segments(src, kind)
    edges = pinned(_edges(segments, kind), "cut-symbols")
    whole = segments.where("not edge")
    matrices = _matrices(whole.select("symbols").unionByName(edges.select("symbols")))
    # The matrices are one row per distinct sequence: a side that Spark sends to the texts if it
    # is small.
    single = whole.join(matrices, "symbols")
    verdicts = pinned(_verdicts(_ordered(edges.join(matrices, "symbols")), kind), "cut-verdicts")
    cut = segments.where("edge").select("conv", "part", "no", "roles", "texts").join(verdicts.select("part", "no", "audit"), ["part", "no"], "left")
    return single, _ordered(cut), verdicts, kind


def repair_conversations(rows: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """One row per conversation: conv_id, gaps (turn numbers missing between the first and the
    last), blank, duplicate, truncated (first faults of its rows), illegal (neighbours whose
    roles don't follow each other), cost and audit of the cheapest edits, repaired_sha256."""
    single, cut, verdicts, kind = _work(rows, conv_id, turn, role, text)
    hashes = _hashes(cut, kind).withColumnRenamed("conv", "c")
    met = verdicts.join(hashes, F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    both = _whole(single, kind).unionByName(met)
    return both.select(F.col("conv").alias("conv_id"), *[c for c in _VERDICT_NAMES if c not in ("part", "no")], "repaired_sha256")


def repaired_rows(rows: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), edit (K, R or I), role, text."""
    single, cut, _, kind = _work(rows, conv_id, turn, role, text)
    audits = _whole(single, kind).select("part", "no", "audit")
    whole = single.select("conv", "part", "no", "roles", "texts").join(audits, ["part", "no"])
    return _repaired(whole, kind).unionByName(_repaired(cut, kind)).withColumnRenamed("conv", "conv_id")


def damage(rows: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """(conv_id, turn, role, text) with a twentieth each, by a checksum of ``conv_id:turn``,
    dropped, emptied, without full stops, repeated, or said by the user. Nulls are one space."""
    said = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(said(conv_id), F.lit(":"), said(turn))) % 20
    kept = rows.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), said(role).alias("role"), said(text).alias("text"), fate.alias("fate")).where("fate != 0")
    spoilt = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("fate") == 3, 2).otherwise(1)
    return kept.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), spoilt.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy"),
    ).drop("copy")
