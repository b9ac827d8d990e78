"""Best-fit packing by length patterns (operator 7).

Documents are cut into pieces of at most ``capacity`` tokens. The histogram of piece lengths,
at most ``capacity`` numbers whatever the corpus, is packed on the driver: patterns of one to
three lengths that fill a sequence exactly are fitted to the histogram by non-negative least
squares, the repeat counts are rounded down, and what is left is packed best fit, longest
first, by whole counts of equal lengths. The plan says which ranks of each length go where;
pieces are ranked within their length by Spark and joined to it.

Ranks are positions within a task and length, plus the counts of the tasks before, so a
length that most pieces share is never gathered in one task.

Defined cases: a null or empty text is one piece that holds the end id only; repeated rows and
ids are packed row by row; longer documents are cut, the last piece may be shorter; a document
of exactly the capacity is one sequence; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketspark.llm import wordpieces
from basketspark.llm.text import pinned, renamed, slices

CAPACITY = 2048
END_ID = 0
FIT_ROUNDS = 300

#: One kind of sequence: ((length, how many of it), ...) in order of place, and how often.
Kind = tuple[tuple[tuple[int, int], ...], int]


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, place) per piece; place counts the pieces
    of the same length in the task. Written once, which pins task and place."""
    with open(tokenizer_path, encoding="utf-8") as f:
        raw = f.read()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, task = wordpieces.load(raw), TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for batch in batches:
            for begin, _, texts in slices(batch, "text"):
                out = []
                for i, ids in enumerate(model.encode([t.decode() for t in texts])):
                    ids = np.append(ids, np.int32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        out.append((begin + i, piece, start, len(part), zlib.crc32(part.tobytes()), task, seen[len(part)]))
                        seen[len(part)] += 1
                row, *rest = (np.array(c) for c in zip(*out))
                kinds = (np.int32, np.int64, np.int64, np.int64, np.int32, np.int64)
                columns = [batch.column("doc_id").take(pa.array(row)), *[pa.array(c.astype(k)) for c, k in zip(rest, kinds)]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"])

    src = renamed(docs, {doc_id: "doc_id", text: "text"})
    schema = f"doc_id {dict(src.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long, task int, place long"
    return pinned(src.mapInArrow(rows, schema), "pieces")


def length_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of three lengths (0: none) that add up to the capacity, longest first."""
    some = np.zeros(capacity + 1, bool)
    some[lengths] = True
    pairs = [(a, capacity - a, 0) for a in lengths.tolist() if 2 * a >= capacity and a < capacity and some[capacity - a]]
    triples = []
    for a in lengths[3 * lengths >= capacity].tolist():
        b = lengths[(lengths <= a) & (lengths < capacity - a) & (2 * lengths >= capacity - a)]
        b = b[some[capacity - a - b]]
        triples.append(np.stack([np.full(len(b), a), b, capacity - a - b], 1))
    whole = [(capacity, 0, 0)] if some[capacity] else []
    return np.concatenate([np.array(whole + pairs, np.int64).reshape(-1, 3), *triples])


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Non-negative least squares: repeats x >= 0 of the patterns whose use of each length is
    nearest to the histogram, by accelerated projected gradients. Lengths are scaled by their
    count, so that rare ones weigh as much as frequent ones."""
    weight = 1.0 / np.maximum(histogram, 1.0)
    weight[0] = 0.0
    use = lambda x: sum(np.bincount(p, x, len(histogram)) for p in patterns.T)
    slope = lambda x: sum(w[p] for w in [(use(x) - histogram) * weight] for p in patterns.T)
    # Diagonal step sizes: each pattern's own curvature times what shares its lengths.
    share = use(np.ones(len(patterns)))
    step = 1.0 / np.maximum(sum((weight * share)[p] for p in patterns.T), 1e-12)
    x = np.zeros(len(patterns))
    y, t = x, 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - step * slope(y))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def best_fit(left: np.ndarray, capacity: int) -> list[Kind]:
    """Best fit, longest first, on counts: all pieces of a length go at once to the open
    sequences with the least room that still holds them, as many as there are of either."""
    rooms: dict[int, list[Kind]] = {}  # by room left
    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            room = next((r for r in range(length, capacity) if rooms.get(r)), None)
            if room is None:
                per = capacity // length  # new sequences, filled with this length alone
                full, rest = divmod(count, per)
                for n, times in ((per, full), (rest, 1)):
                    if n and times:
                        rooms.setdefault(capacity - n * length, []).append((((length, n),), times))
                count = 0
                continue
            kind, times = rooms[room].pop()
            per = room // length
            whole = min(times, count // per)
            if whole:
                rooms.setdefault(room - per * length, []).append(((*kind, (length, per)), whole))
                count -= whole * per
            if whole < times:
                if count:  # fewer than `per` are left: one more sequence takes them
                    rooms.setdefault(room - count * length, []).append(((*kind, (length, count)), 1))
                    whole, count = whole + 1, 0
                if whole < times:
                    rooms.setdefault(room, []).append((kind, times - whole))
    return [kind for kinds in rooms.values() for kind in kinds]


def plan_sequences(histogram: np.ndarray, capacity: int = CAPACITY) -> list[Kind]:
    """Kinds of sequences that hold every piece of the histogram (index: length) once."""
    left = histogram.astype(np.int64).copy()
    kinds: list[Kind] = []
    patterns = length_patterns(np.flatnonzero(left), capacity)
    if len(patterns):
        repeats = fit_repeats(patterns, left.astype(float))
        for i in np.argsort(-repeats, kind="stable").tolist():
            need = Counter(p for p in patterns[i].tolist() if p)
            n = min(int(repeats[i] + 1e-6), *(int(left[p]) // k for p, k in need.items()))
            if repeats[i] < 1 - 1e-6:
                break
            if n:
                kinds.append((tuple(need.items()), n))
                for p, k in need.items():
                    left[p] -= n * k
    return kinds + best_fit(left, capacity)


def _plan_table(spark: SparkSession, kinds: list[Kind]) -> DataFrame:
    """One row per kind and length: (length, lo, hi, first_sequence, per, begin)."""
    taken: Counter[int] = Counter()
    rows, sequence = [], 0
    for parts, times in kinds:
        offset = 0
        for length, per in parts:
            rows.append((length, taken[length], taken[length] + times * per, sequence, per, offset))
            taken[length] += times * per
            offset += length * per
        sequence += times
    return spark.createDataFrame(rows, "len long, lo long, hi long, first_sequence long, per long, begin long")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset. pieces: length, task, place and other columns."""
    counts = pinned(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
        histogram[row.length] = row.n
    plan = _plan_table(pieces.sparkSession, plan_sequences(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # A window over the tasks of a length: as many rows as there are tasks.
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select("length", "task", "base", "n")
    # A length's ranks in a task are a run, so the plan's rows meet it as intervals first and
    # each piece then takes its own row: both sides are counts, not pieces.
    met = base.join(plan, (F.col("length") == F.col("len")) & (F.col("lo") < F.col("base") + F.col("n")) & (F.col("hi") > F.col("base")))
    runs = met.groupBy("length", "task").agg(
        F.first("base").alias("base"), F.sort_array(F.collect_list(F.struct("lo", "hi", "first_sequence", "per", "begin"))).alias("runs")
    )
    joined = pieces.join(runs, ["length", "task"])
    rank = F.col("place") + F.col("base")
    run = F.filter("runs", lambda r: (r["lo"] <= rank) & (rank < r["hi"]))[0]
    joined = joined.withColumns({"_rank": rank, "_run": run})
    at = F.col("_rank") - F.col("_run.lo")
    per = F.col("_run.per")
    nth = F.expr("(_rank - _run.lo) div _run.per")
    return joined.withColumns({
        "sequence_id": (F.col("_run.first_sequence") + nth).cast("long"),
        "offset": (F.col("_run.begin") + (at - nth * per) * F.col("length")).cast("long"),
    }).drop("_rank", "_run", "runs", "base")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, doc_id="doc_id", text="text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = cut_pieces(docs, tokenizer_path, capacity, end_id, doc_id, text)
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
