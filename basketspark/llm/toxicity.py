"""Toxicity by classifier chains (operator 8).

Categories are predicted one after another by linear models; each later model also sees the
logits of the earlier categories' probabilities. So that these inputs mean the same in training
as in use, the later models are trained on out-of-fold predictions of the earlier ones.

Features of each ASCII-lower-cased word (a run of letters) are the word as a whole, its first 3,
4, 5, 6 and 8 bytes if it is longer than these, and n-grams of code points over all of it, so
that scripts without spaces are read to the last character: of 2, 3, 4 and 6 if it has a character
from U+0800 on, of 4 and 6 if it is another word over 8 bytes. They are hashed, present or
absent. All characters beyond ASCII count as letters but Latin-1, general, ideographic and
full-width punctuation. For each category and fold the
features that tell most (chi-square on documents outside the fold) are kept.

Training reads a bounded sample: about ``sample_rows`` labelled documents, chosen by a hash of
their id. Their feature counts are summed by Spark; only the chosen features of the sample and
the models reach the driver. Scoring is one pass over whole texts without a shuffle.

Defined cases: a null text has no features; labels that are null or without a document are
ignored and repeated ones agree on the largest; without labels of both classes a category's
probability is its base rate (0 if none) and nothing is flagged; rows are scored one by one,
whatever their ids; an empty table gives an empty result; ``drop_toxic`` keeps all columns.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketspark.llm.text import mix, package_path, pinned, range_hashes, renamed, slices

PREFIXES = (3, 4, 5, 6, 8)
#: Code points of the n-grams of dense words (with a character from U+0800 on), and of other words
#: longer than the longest prefix.
GRAMS = (2, 3, 4, 6)
LONG_GRAMS = (4, 6)
BUCKET_BITS = 18
#: Categories in the order of the chain: name and when a row of labels has it.
CATEGORIES = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"))


@dataclasses.dataclass(frozen=True)
class ChainConfig:
    sample_rows: int = 12_000
    folds: int = 3
    features: int = 2048  # per category
    min_docs: int = 3
    rounds: int = 150
    penalty: float = 1e-2


@dataclasses.dataclass(frozen=True)
class LinearModel:
    features: np.ndarray  # buckets, sorted
    weights: np.ndarray  # of the features
    chain: np.ndarray  # of the earlier categories' logits
    bias: float


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


_SPREAD = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Ranges of punctuation beyond ASCII, and the first bytes of their characters.
_MARKS = ((0x80, 0xA9), (0xAB, 0xB4), (0xB6, 0xB9), (0xBB, 0xBF), (0x2000, 0x200B), (0x2010, 0x206F), (0x3000, 0x3004), (0x3008, 0x303F), (0x30FB, 0x30FB), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))
_FIRST = np.isin(np.arange(256), [0xC2, 0xE2, 0xE3, 0xEF])


def _letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters. The data ends with two zero bytes at least."""
    letter = _LETTER[data]
    at = np.flatnonzero(_FIRST[data])
    one, two, three = (data[at + k].astype(np.int32) for k in range(3))
    short = one == 0xC2
    point = np.where(short, (one & 31) << 6 | two & 63, (one & 15) << 12 | (two & 63) << 6 | three & 63)
    mark = np.zeros(len(at), bool)
    for low, high in _MARKS:
        mark |= (point >= low) & (point <= high)
    letter[at[mark]] = letter[at[mark] + 1] = False
    letter[at[mark & ~short] + 2] = False
    return letter


def _grams(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(code points, begins, ends, word numbers) of the n-grams that words have as features."""
    high = np.concatenate([[0], np.cumsum(data >= 0xE0)])
    dense = high[end] > high[begin]
    some = np.flatnonzero(dense | (end - begin > PREFIXES[-1]))
    edge = np.zeros(len(data), np.int8)
    edge[begin[some]] = 1
    edge[end[some]] = -1  # a word is followed by another byte at least, so no word begins there
    start = np.flatnonzero((np.cumsum(edge, dtype=np.int8) > 0) & (data & 0xC0 != 0x80))
    word = np.searchsorted(begin, start, "right") - 1
    for n in sorted({*GRAMS, *LONG_GRAMS}):
        first = np.flatnonzero(word[: len(word) - n + 1] == word[n - 1 :]) if len(word) >= n else np.zeros(0, np.int64)
        first = first[np.where(dense[word[first]], n in GRAMS, n in LONG_GRAMS)]
        after = np.minimum(first + n, max(0, len(word) - 1))
        inside = (first + n < len(word)) & (word[after] == word[first])
        yield n, start[first], np.where(inside, start[after], end[word[first]]), word[first]


def prefix_features(texts: list[bytes], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of the distinct features of each text; only those in ``keep``."""
    data = np.frombuffer(b"\n".join(texts) + b"\n" + bytes(8), np.uint8)
    letter = _letters(data)
    begin = np.flatnonzero(letter & ~np.concatenate([[False], letter[:-1]]))
    end = np.flatnonzero(letter & ~np.concatenate([letter[1:], [False]])) + 1
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), begin, "right")
    size = end - begin
    low = _LOWER[data]
    out: list[np.ndarray] = []

    def add(keys: np.ndarray, where: np.ndarray) -> None:
        bucket = (mix(keys) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        if keep is not None:
            some = keep[bucket]
            bucket, where = bucket[some], where[some]
        out.append(np.unique(where << BUCKET_BITS | bucket))

    word = np.zeros(len(begin), np.uint64)
    last = 0
    for p in PREFIXES:
        for k in range(last, p):
            word |= np.where(size > k, low[np.minimum(begin + k, len(data) - 1)], 0).astype(np.uint64) << np.uint64(8 * k)
        last = p
        able = size > p
        add(word[able] * np.uint64(16) + np.uint64(p), owner[able])
    parts = [(0, begin, end, np.arange(len(begin))), *_grams(data, begin, end)]
    hashes = range_hashes(_SPREAD[low], np.concatenate([x[1] for x in parts]), np.concatenate([x[2] for x in parts]))
    for (n, first, _, of), keys in zip(parts, np.split(hashes, np.cumsum([len(x[1]) for x in parts])[:-1])):
        add(keys + np.uint64(n), owner[of])
    both = np.unique(np.concatenate(out))
    return both >> BUCKET_BITS, both & ((1 << BUCKET_BITS) - 1)


def _labelled_sample(docs: DataFrame, labels: DataFrame, categories, cfg: ChainConfig) -> DataFrame:
    """(text, fold, y: array of 0/1) of about ``sample_rows`` labelled documents. Written once."""
    truth = [F.max(F.expr(rule).cast("int")).alias(name) for name, rule in categories]
    ys = labels.groupBy(F.col("doc_id").alias("id")).agg(*truth).where(" and ".join(f"{n} is not null" for n, _ in categories) + " and id is not null")
    ys = pinned(ys, "label-rows")
    share = min(1.0, cfg.sample_rows / max(1, ys.count()))
    draw = F.pmod(F.xxhash64(F.lit(11), F.col("id")), F.lit(1 << 20))
    chosen = ys.where(draw < int(share * (1 << 20)) + 1).select("id", F.array(*[n for n, _ in categories]).alias("y"))
    fold = F.pmod(F.xxhash64(F.lit(5), F.col("id")), F.lit(cfg.folds)).cast("int").alias("fold")
    # The sample's labels are bounded by sample_rows, so they may be broadcast.
    return pinned(docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("id")).select("text", "y", fold), "label-sample")


def _feature_counts(sample: DataFrame, n_categories: int, folds: int, min_docs: int) -> np.ndarray:
    """counts[bucket, fold, 0] documents, [.., 1 + c] documents of category c."""
    wide = folds * (1 + n_categories)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(wide << BUCKET_BITS, np.int64)
        for batch in batches:
            ys = np.array(batch.column("y").to_pylist(), np.int64).reshape(-1, n_categories)
            fold = batch.column("fold").to_numpy()
            for begin, end, texts in slices(batch, "text"):
                doc, bucket = prefix_features(texts)
                at = bucket * wide + fold[begin + doc] * (1 + n_categories)
                total += np.bincount(at, minlength=len(total))
                for c in range(n_categories):
                    total += np.bincount(at[ys[begin + doc, c] == 1] + 1 + c, minlength=len(total))
        table = total.reshape(-1, wide)
        some = np.flatnonzero(table.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(table[some, k]) for k in range(wide)]], names=["bucket", *[f"n{k}" for k in range(wide)]])

    names = [f"n{k}" for k in range(wide)]
    counted = sample.mapInArrow(rows, "bucket long, " + ", ".join(f"{n} long" for n in names))
    summed = counted.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names])
    least = sum(F.col(f"n{f * (1 + n_categories)}") for f in range(folds)) >= min_docs
    out = np.zeros((1 << BUCKET_BITS, wide), np.int64)
    found = summed.where(least).toPandas()  # as many rows as buckets at most
    out[found["bucket"].to_numpy()] = found[names].to_numpy()
    return out.reshape(-1, folds, 1 + n_categories)


def _choose(counts: np.ndarray, docs: int, positive: int, most: int, min_docs: int) -> np.ndarray:
    """Buckets with the largest chi-square between presence and the category."""
    n, k = counts[:, 0].astype(float), counts[:, 1].astype(float)
    if not 0 < positive < docs:
        return np.zeros(0, np.int64)
    expect = n * positive / docs
    score = (k - expect) ** 2 / np.maximum(expect, 1e-9) / np.maximum((1 - n / docs) * (1 - positive / docs), 1e-9)
    score[n < min_docs] = -1
    best = np.argsort(-score, kind="stable")[:most]
    return np.sort(best[score[best] > 0])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _terms(model_features: np.ndarray, doc: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(model_features, bucket)
    at[at == len(model_features)] = 0
    hit = model_features[at] == bucket if len(model_features) else np.zeros(len(bucket), bool)
    return doc[hit], at[hit]


def fit_linear(doc, bucket, features, chain, y, use, cfg: ChainConfig) -> LinearModel:
    """Logistic regression on the documents in ``use`` by Adam steps on the whole sample. A
    feature's value is its log-odds between the classes (naive Bayes), so that with few
    documents the penalty holds back the features that tell little."""
    n = len(y)
    rate = float(y[use].mean()) if use.any() else 0.0
    if not 0 < rate < 1:
        return LinearModel(features, np.zeros(len(features)), np.zeros(chain.shape[1]), 30.0 if rate == 1 else -30.0)
    d, f = _terms(features, doc, bucket)
    some = use[d]
    d, f = d[some], f[some]
    size, positive, k = use.sum(), y[use].sum(), len(features)
    with_it, with_both = np.bincount(f, minlength=k), np.bincount(f, y[d], k)
    odds = np.log((with_both + 0.5) / (positive + 1)) - np.log((with_it - with_both + 0.5) / (size - positive + 1))
    theta = np.zeros(k + chain.shape[1] + 1)
    theta[-1] = _logit(np.array(rate))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, cfg.rounds + 1):
        z = np.bincount(d, (theta[:k] * odds)[f], n) + chain @ theta[k:-1] + theta[-1]
        error = np.where(use, _sigmoid(z) - y, 0.0)
        grad = np.concatenate([np.bincount(f, error[d], k) * odds, chain.T @ error, [error.sum()]]) / size
        grad[:-1] += cfg.penalty * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= 0.05 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
    return LinearModel(features, theta[:k] * odds, theta[k:-1], float(theta[-1]))


def predict(model: LinearModel, n: int, doc: np.ndarray, bucket: np.ndarray, chain: np.ndarray) -> np.ndarray:
    d, f = _terms(model.features, doc, bucket)
    return _sigmoid(np.bincount(d, model.weights[f], n) + chain @ model.chain + model.bias)


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut with the best F0.5 on out-of-fold predictions, in the middle of its gap: a clean
    document lost counts for more than a toxic one missed."""
    if not 0 < y.sum() < len(y):
        return 2.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    score = 1.25 * hits / (np.arange(1, len(y) + 1) + 0.25 * y.sum())
    best = int(np.argmax(score))
    below = p[order[best + 1]] if best + 1 < len(y) else 0.0
    return float(min(0.9, max(0.1, (p[order[best]] + below) / 2)))


@dataclasses.dataclass(frozen=True)
class Chain:
    names: list[str]
    models: list[LinearModel]
    thresholds: list[float]
    oof: np.ndarray  # out-of-fold probabilities of the sample, by category
    truth: np.ndarray


def fit_chain(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, cfg: ChainConfig = ChainConfig(), doc_id="doc_id", text="text") -> Chain:
    """The chain, fitted to the labelled documents. labels: doc_id and what the rules name."""
    sample = _labelled_sample(renamed(docs, {doc_id: "doc_id", text: "text"}), labels, categories, cfg)
    k = len(categories)
    counts = _feature_counts(sample, k, cfg.folds, cfg.min_docs)
    totals = {r.fold: r for r in sample.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("y")[c]).alias(f"y{c}") for c in range(k)]).collect()}
    chosen: dict[tuple[int, int], np.ndarray] = {}
    for c in range(k):
        for fold in range(-1, cfg.folds):  # -1: no fold is left out
            in_use = [f for f in range(cfg.folds) if f != fold and f in totals]
            docs_in, pos_in = sum(totals[f].n for f in in_use), sum(totals[f][f"y{c}"] for f in in_use)
            inside = counts[:, [f for f in range(cfg.folds) if f != fold]].sum(1)[:, [0, 1 + c]]
            chosen[c, fold] = _choose(inside, docs_in, pos_in, cfg.features, cfg.min_docs)
    keep = np.zeros(1 << BUCKET_BITS, bool)
    for some in chosen.values():
        keep[some] = True

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, texts in slices(batch, "text"):
                doc, bucket = prefix_features(texts, keep)
                lists = [x.astype(np.int32) for x in np.split(bucket, np.searchsorted(doc, np.arange(1, len(texts))))]
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([part.column("fold"), part.column("y"), pa.array([x.tobytes() for x in lists])], names=["fold", "y", "f"])

    # The sample is bounded, and so are the features kept of each document.
    found = sample.mapInArrow(rows, "fold int, y array<int>, f binary").collect()
    lists = [np.frombuffer(r.f, np.int32) for r in found]
    doc = np.repeat(np.arange(len(found)), [len(x) for x in lists]).astype(np.int64)
    bucket = np.concatenate([*lists, np.zeros(0, np.int32)]).astype(np.int64)
    fold = np.array([r.fold for r in found], np.int64)
    y = np.array([r.y for r in found], float).reshape(-1, k)
    oof, models, cuts = np.zeros((len(found), k)), [], []
    for c in range(k):
        before = _logit(oof[:, :c])
        for f in range(cfg.folds):
            model = fit_linear(doc, bucket, chosen[c, f], before, y[:, c], fold != f, cfg)
            oof[fold == f, c] = predict(model, len(found), doc, bucket, before)[fold == f]
        models.append(fit_linear(doc, bucket, chosen[c, -1], before, y[:, c], np.ones(len(found), bool), cfg))
        cuts.append(_threshold(oof[:, c], y[:, c]))
    return Chain([n for n, _ in categories], models, cuts, oof, y)


def chain_scores(chain: Chain, texts: list[bytes]) -> np.ndarray:
    """Probabilities, one column per category in the order of the chain."""
    keep = np.zeros(1 << BUCKET_BITS, bool)
    for m in chain.models:
        keep[m.features] = True
    doc, bucket = prefix_features(texts, keep)
    out = np.zeros((len(texts), len(chain.models)))
    for c, model in enumerate(chain.models):
        out[:, c] = predict(model, len(texts), doc, bucket, _logit(out[:, :c]))
    return out


def score_toxicity(docs: DataFrame, chain: Chain, text: str = "text", probability: str = "p_", flag: str = "is_") -> DataFrame:
    """The documents with all their columns, and of each category its probability and whether
    that reaches the category's threshold, in columns named by the two prefixes."""
    cuts = chain.thresholds
    names = [probability + n for n in chain.names] + [flag + n for n in chain.names]
    light = dataclasses.replace(chain, oof=np.zeros(0), truth=np.zeros(0))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, texts in slices(batch, text):
                p = chain_scores(light, texts)
                part = batch.slice(begin, end - begin)
                columns = [*part.columns, *map(pa.array, p.T), *map(pa.array, (p >= cuts).T)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *names])

    kinds = ["double"] * len(cuts) + ["boolean"] * len(cuts)
    schema = ", ".join(f"`{c}` {t}" for c, t in [*docs.dtypes, *zip(names, kinds)])
    return package_path(docs).mapInArrow(rows, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, category: str = "toxic", text: str = "text") -> DataFrame:
    """The documents that the chain does not put in the category, with their own columns only."""
    flag = "is_"
    while any(c.lower().startswith(flag) for c in docs.columns):
        flag = "_" + flag
    scored = score_toxicity(docs, fit_chain(docs, labels, text=text), text, "_p" + flag, flag)
    return scored.where(~F.col(flag + category)).select(*[F.col(f"`{c}`") for c in docs.columns])
