"""Quality rules with host verdicts (operator 1).

Each document is measured by a few text rules; failures are counted by host, each host's
failure rate is shrunk towards the corpus by a beta prior fitted to all hosts (method of
moments), and the hosts' verdicts are joined back to their documents.

Defined cases: a null text has no words and fails; a null host is no host, so such documents
are judged by their own text only and do not enter the prior; repeated rows and ids are
judged row by row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import dataclasses
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketspark.llm.text import pinned, renamed, slices

#: The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclasses.dataclass(frozen=True)
class RuleConfig:
    min_words: int = 50
    max_repeat_pct: int = 50  # of the words, in windows found twice or more
    window: int = 3
    max_host_rate: float = 0.5  # a host whose shrunk failure rate is above this is refused
    max_prior_docs: float = 1000.0  # weight of the prior where all hosts look alike


def repeat_words(words: list[bytes], window: int) -> int:
    """Words covered by windows of ``window`` words that occur twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = defaultdict()
    ids.default_factory = ids.__len__
    word = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    key = word[:n]
    for k in range(1, window):  # exact: each step renumbers the prefixes, no hash
        key = np.unique(key * len(ids) + word[k : k + n], return_inverse=True)[1]
    twice = np.bincount(key)[key] > 1
    if not twice.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    edge[at] += 1
    edge[at + window] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure_text(text: bytes, window: int = 3) -> tuple[int, int, int, int, int]:
    """The measures in the order of ``MEASURES``."""
    words = text.split()
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = sum(text.count(bytes([c])) for c in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words, window)


def measure(docs: DataFrame, cfg: RuleConfig = RuleConfig(), doc_id="doc_id", text="text", host="source") -> DataFrame:
    """One row per document: doc_id, host, the measures, base_failed (written once)."""
    window = cfg.window

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, texts in slices(batch, "text"):
                found = np.array([measure_text(t, window) for t in texts], np.int64).reshape(-1, len(MEASURES))
                part = batch.slice(begin, end - begin)
                columns = [part.column("doc_id"), part.column("host"), *map(pa.array, found.T)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "host", *MEASURES])

    src = renamed(docs, {doc_id: "doc_id", host: "host", text: "text"})
    kinds = dict(src.dtypes)
    schema = f"doc_id {kinds['doc_id']}, host {kinds['host']}, " + ", ".join(f"{m} long" for m in MEASURES)
    failed = (F.col("n_words") < cfg.min_words) | (100 * F.col("n_repeat_words") > cfg.max_repeat_pct * F.col("n_words"))
    return pinned(src.mapInArrow(rows, schema).withColumn("base_failed", failed), "measures")


def host_verdicts(measured: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """One row per host: host, host_docs, host_failed, host_rate (shrunk), host_kept."""
    hosts = pinned(
        measured.where("host is not null")
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed")),
        "hosts",
    )
    n, k = F.col("host_docs"), F.col("host_failed")
    total = hosts.agg(F.count(F.lit(1)).alias("m"), F.sum(n).alias("n"), F.sum(k).alias("k"), F.sum(n.cast("double") * n).alias("nn")).first()
    if not total.m:
        alpha, beta = 1.0, 1.0
    else:
        mean = total.k / total.n
        between = hosts.agg(F.sum(n * F.pow(k / n - mean, 2))).first()[0]
        # Moments of a beta-binomial: the spread of the hosts' rates beyond what binomial
        # counts have gives the intra-host correlation rho, and 1/rho - 1 is the prior's weight.
        free = mean * (1 - mean)
        scale = total.n - total.nn / total.n
        rho = (between - (total.m - 1) * free) / (free * (scale - (total.m - 1))) if free > 0 and scale > total.m - 1 else 0.0
        weight = min(cfg.max_prior_docs, 1 / rho - 1) if rho > 0 else cfg.max_prior_docs
        alpha, beta = max(mean * weight, 1e-6), max((1 - mean) * weight, 1e-6)
    rate = (k + F.lit(alpha)) / (n + F.lit(alpha + beta))
    return hosts.withColumn("host_rate", rate).withColumn("host_kept", F.col("host_rate") <= cfg.max_host_rate)


def quality_rules(docs: DataFrame, cfg: RuleConfig = RuleConfig(), doc_id="doc_id", text="text", host="source") -> DataFrame:
    """Measures, base_failed, the host's figures and kept, one row per document row.

    kept is false for a document that fails the rules itself or whose host is refused."""
    measured = measure(docs, cfg, doc_id, text, host)
    # A plain join: Spark broadcasts few hosts by their real size and splits a hot host.
    joined = measured.join(host_verdicts(measured, cfg), "host", "left")
    kept = ~F.col("base_failed") & F.coalesce(F.col("host_kept"), F.lit(True))
    return joined.withColumn("kept", kept).select(
        "doc_id", *MEASURES, "base_failed", "kept", "host", "host_docs", "host_failed", "host_rate"
    )
