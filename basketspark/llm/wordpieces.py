"""Ids of a word-level byte-pair tokenizer file (word ends marked, lower case, white space
dropped), equal to the tokenizers library's ``encode(text, add_special_tokens=False)``.

Words are found and merged on flat code point arrays (``merges``), each distinct word once a
chunk. That path takes texts of Basic Latin, Latin-1 and Latin Extended-A letters, whose
classes and lower case are the same in every Unicode version and which are already
normalised; any other text, and one that may spell a special token, goes through the library.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
from tokenizers import Tokenizer

from basketspark.llm.merges import MergeTable, code_points, encode_parts, merge_words, split_ids

_TOP = 0x180
#: Texts of these characters only take the array path.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-įı-ſ]*").fullmatch
#: What the file must say of its normaliser and its word pattern.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_OTHER, _SPACE, _DIGIT, _LETTER = 0, 1, 2, 3


def _byte_names() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1
    characters for themselves, the other bytes by code points from 256 up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordModel:
    def __init__(self, raw: str):
        spec = json.loads(raw)
        model, words = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        plain = (
            model["type"] == "BPE" and model["end_of_word_suffix"] == "</w>" and not model["continuing_subword_prefix"] and not model["ignore_merges"]
            and spec["normalizer"].get("normalizers") == _NORMALIZERS and words[0]["pattern"] == {"Regex": _PATTERN} and words[0]["behavior"] == "Removed" and words[0]["invert"]
            and words[1] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False} and not spec.get("truncation")
        )
        if not plain:
            raise ValueError("this tokenizer file has parts that the array path does not cover")
        self.library = Tokenizer.from_str(raw)
        self.special = tuple(t["content"] for t in spec["added_tokens"])
        vocab, name = model["vocab"], _byte_names()
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        pairs = np.array([(vocab[a], vocab[b], r, vocab[a + b]) for r, (a, b) in enumerate(merges)], np.int64)
        self.table = MergeTable(*pairs.T)
        self.inner = np.array([vocab[name[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[name[b] + "</w>"] for b in range(256)], np.int32)
        of = {"L": _LETTER, "N": _DIGIT}
        self.kind = np.array([_SPACE if chr(c).isspace() else of.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(_TOP)], np.int8)
        self.lower = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(_TOP)], np.uint32)

    def _encode(self, points: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of code points below 0x180: one or two bytes each."""
        two = points >= 0x80
        ends = np.cumsum(counts + np.add.reduceat(two, np.cumsum(counts) - counts))
        size = np.diff(ends, prepend=0)
        data = np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        symbols = self.inner[data]
        symbols[ends - 1] = self.last[data[ends - 1]]
        return merge_words(symbols, size, self.table)

    def _words(self, points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, end) of the words, by the tokenizer's pattern."""
        kind = self.kind[points]
        begins = np.ones(len(points), bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        begins[first[:-1][np.diff(first) > 0]] = True
        # An apostrophe that begins a run of other characters takes a contraction's letters.
        mark = np.flatnonzero((points == ord("'")) & begins)
        if len(mark):
            text = np.searchsorted(first, mark, "right")
            padded = np.append(points, [0, 0]).astype(np.uint32)
            room = first[text] - mark
            one, both = padded[mark + 1], padded[mark + 1].astype(np.uint64) << np.uint64(32) | padded[mark + 2]
            long = np.isin(both, [ord(x[0]) << 32 | ord(x[1]) for x in ("re", "ve", "ll")]) & (room > 2)
            short = np.isin(one, [ord(x) for x in "stmd"]) & (room > 1)
            begins[mark[short | long] + 1] = False
            at = mark[short] + 2
            begins[at[at < len(points)]] = True
            at = mark[long] + 3
            begins[at[at < len(points)]] = True
        begin = np.flatnonzero(begins)
        end = np.append(begin[1:], len(points))
        some = kind[begin] != _SPACE
        return begin[some], end[some]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        plain = [bool(_PLAIN(t)) and not any(s in t for s in self.special) for t in texts]
        some = [t for t, x in zip(texts, plain) if x]
        points, first = code_points(some)
        out: list[np.ndarray] = []
        if len(points):
            points = self.lower[points]
            begin, end = self._words(points, first)
            ids, n = encode_parts(points, begin, end, self._encode)
            out = split_ids(ids, n, begin, first)
        else:
            out = [np.zeros(0, np.int32) for _ in some]
        done = iter(out)
        other = iter(self.library.encode_batch([t for t, x in zip(texts, plain) if not x], add_special_tokens=False))
        return [next(done) if x else np.array(next(other).ids, np.int32) for x in plain]


_MODELS: dict[str, WordModel] = {}


def load(raw: str) -> WordModel:
    """The model of a tokenizer file's text, once per worker process."""
    if raw not in _MODELS:
        _MODELS[raw] = WordModel(raw)
    return _MODELS[raw]
