"""SentencePiece encoding and decoding (operator 9).

Byte-pair models of the sentencepiece library: the ids are worked out by vectorised merge
rounds (``merges``), not by the library, and equal the library's. Decoding is the library's
own ``decode``. The model file is read once on the driver and travels with the tasks.

Any two adjacent symbols whose concatenation is a piece may merge, best score first and
leftmost if equal. Texts are cut where no piece crosses, before a word mark that follows
another character and around characters that no piece holds, and each distinct part is
merged once per chunk of texts.

Defined cases: a null or empty text has no ids and decodes to an empty text; characters
without a piece become byte pieces; repeated rows and ids are encoded row by row; texts of any
length are encoded whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from basketspark.llm.merges import MergeTable, code_points, encode_parts, merge_words, split_ids
from basketspark.llm.text import pinned, renamed, slices

MARK = "▁"
#: Fixed values of the model file's format: piece types that take part in merges, and bytes.
_NORMAL, _UNKNOWN, _BYTE = {1, 4, 5}, 2, 6


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protocol buffer message."""

    def number(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (raw[i] & 127) << shift
            i, shift = i + 1, shift + 7
            if raw[i - 1] < 128:
                return value, i

    i = 0
    while i < len(raw):
        tag, i = number(i)
        kind = tag & 7
        if kind == 0:
            value, i = number(i)
        else:
            size, i = number(i) if kind == 2 else (4 if kind == 5 else 8, i)
            value, i = raw[i : i + size], i + size
        yield tag >> 3, value


class PieceModel:
    """What the merges need to know of a byte-pair model with byte fallback."""

    def __init__(self, raw: bytes):
        pieces: list[tuple[str, float, int]] = []
        trainer: dict = {}
        normal: dict = {}
        for field, value in _fields(raw):
            if field == 1:
                f = dict(_fields(value))
                pieces.append((f[1].decode(), struct.unpack("<f", f.get(2, bytes(4)))[0], f.get(3, 1)))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normal = dict(_fields(value))
        # Fixed values of the format: model type 2 is byte pairs, 35 is byte fallback; of the
        # normaliser 2 is its character map, 3 the leading mark, 4 the removal of extra spaces.
        if trainer.get(3) != 2 or not trainer.get(35) or normal.get(2) or not normal.get(3, 1) or normal.get(4, 1):
            raise ValueError("a byte-pair model with byte fallback and no text normalisation is needed")
        if any(kind in (4, 5) for *_, kind in pieces):
            raise ValueError("user-defined and unused pieces are not handled")
        merging = {p: (s, i) for i, (p, s, kind) in enumerate(pieces) if kind in _NORMAL}
        self.bytes = np.zeros(256, np.int32)
        for i, (p, _, kind) in enumerate(pieces):
            if kind == _BYTE:
                self.bytes[int(p[1:-1], 16)] = i
        n = len(pieces)
        symbol = {p: i for p, (_, i) in merging.items()}
        chars = sorted({c for p in merging for c in p})
        for c in chars:  # a character inside pieces that is no piece itself is a symbol still
            symbol.setdefault(c, n + ord(c))
        self.base = n  # symbol of a character without a piece: base + its code point
        self.char = np.arange(0x110000, dtype=np.int32) + n
        for c in chars:
            self.char[ord(c)] = symbol[c]
        scores = sorted({s for s, _ in merging.values()}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        pairs = [
            (symbol[p[:k]], symbol[p[k:]], rank[s], i)
            for p, (s, i) in merging.items()
            for k in range(1, len(p))
            if p[:k] in symbol and p[k:] in symbol
        ]
        self.table = MergeTable(*np.array(pairs, np.int64).reshape(-1, 4).T)
        if any(MARK in p.lstrip(MARK) or " " in p for p in merging):
            raise ValueError("pieces that cross a word mark are not handled")
        self.alone = np.array([c for c in (9, 10, 13) if chr(c) not in chars], np.uint32)
        self.char[32] = symbol[MARK]

    def _encode(self, points: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, n = merge_words(self.char[points], counts, self.table)
        lost = np.flatnonzero(left >= self.base)  # characters without a piece become their bytes
        if not len(lost):
            return left, n
        owner = np.repeat(np.arange(len(n)), n)
        spelt = [chr(c).encode() for c in (left[lost] - self.base).tolist()]
        extra = np.ones(len(left), np.int64)
        extra[lost] = list(map(len, spelt))
        out = np.repeat(left, extra)
        out[np.repeat(left >= self.base, extra)] = self.bytes[np.frombuffer(b"".join(spelt), np.uint8)]
        return out, np.bincount(owner, extra, len(n)).astype(np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        points, first = code_points([" " + t.replace(MARK, " ") if t else "" for t in texts])
        if not len(points):
            return [np.zeros(0, np.int32) for _ in texts]
        space, alone = points == 32, np.isin(points, self.alone)
        cut = np.zeros(len(points), bool)
        cut[1:] = (space[1:] & ~space[:-1]) | (alone[1:] != alone[:-1])
        cut[first[:-1][np.diff(first) > 0]] = True
        begin = np.flatnonzero(cut)
        ids, n = encode_parts(points, begin, np.append(begin[1:], len(points)), self._encode)
        return split_ids(ids, n, begin, first)


_MODELS: dict[bytes, tuple[PieceModel, sentencepiece.SentencePieceProcessor]] = {}


def load(raw: bytes) -> tuple[PieceModel, sentencepiece.SentencePieceProcessor]:
    """The model and the library's processor, once per worker process."""
    digest = hashlib.sha256(raw).digest()
    if digest not in _MODELS:
        _MODELS[digest] = PieceModel(raw), sentencepiece.SentencePieceProcessor(model_proto=raw)
    return _MODELS[digest]


def encode_texts(docs: DataFrame, model_path: str, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, ids: array of int, decoded) per document row."""
    return _run(docs, model_path, doc_id, text, digest=False)


def encode_digests(docs: DataFrame, model_path: str, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per document row. Written once."""
    return pinned(_run(docs, model_path, doc_id, text, digest=True), "piece-digests")


def _run(docs: DataFrame, model_path: str, doc_id: str, text: str, digest: bool) -> DataFrame:
    with open(model_path, "rb") as f:
        raw = f.read()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, library = load(raw)
        for batch in batches:
            for begin, end, texts in slices(batch, "text"):
                ids = [x.tolist() for x in model.encode([t.decode() for t in texts])]
                decoded = [library.decode(x) if x else "" for x in ids]
                own = batch.column("doc_id").slice(begin, end - begin)
                if digest:
                    shas = [[hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in ids], [hashlib.sha256(x.encode()).hexdigest() for x in decoded]]
                    yield pa.RecordBatch.from_arrays([own, pa.array([len(x) for x in ids], pa.int64()), *map(pa.array, shas)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    yield pa.RecordBatch.from_arrays([own, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded)], names=["doc_id", "ids", "decoded"])

    src = renamed(docs, {doc_id: "doc_id", text: "text"})
    rest = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"
    return src.mapInArrow(rows, f"doc_id {dict(src.dtypes)['doc_id']}, {rest}")
