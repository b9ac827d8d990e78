"""Operators 11 to 13 against their plain versions: null, empty and very long values, ties,
repeated rows, empty tables, clashing columns, and very uneven groups."""

from __future__ import annotations

import os
import random
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from basketspark.llm import collocations, conversations, piecewise  # noqa: E402
from basketspark.llm.queries import QUERIES  # noqa: E402

CLASH = ["conv", "part", "no", "symbols", "audit", "k1", "k2", "head", "tail", "h", "n", "phrase", "words", "shard", "edge", "copy", "fate", "rank"]
VERDICT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def clashing(df):
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASH})


# --- 11 ---


def talks():
    rnd = random.Random(5)
    rows = []
    for c in range(120):
        for t in range(rnd.randint(1, 12)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "Sys", None])
            text = rnd.choice([f"words {rnd.randint(0, 9)}.", "no end", "Yes!", "", " \n", None, f"x{t}?", "日本。", "é."])
            rows.append((c, rnd.choice([t, t, t, None]), role, text))
    rows += [(500, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(40)]
    rows += [(501, 3, "user", "The same.")] * 7 + [(502, None, "user", None), (None, 1, "user", "Lost."), (None, None, None, None)]
    rows += [(503, 1, "user", "y" * 200_000 + "."), (503, 2, "assistant", "z" * 200_000)]
    rows += [(600, 2 * t + (t > 300), ("user", "assistant", "assistant")[t % 3], f"Reply {t % 350}" + ".!"[t % 2]) for t in range(900)]
    return rows


TALK = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("segment_rows,partitions", [(8192, 8), (7, 3)])
def test_conversations(spark, monkeypatch, segment_rows, partitions):
    monkeypatch.setattr(conversations, "SEGMENT_ROWS", segment_rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(partitions > 3).lower())
    try:
        df = clashing(spark.createDataFrame(talks(), TALK).repartition(partitions))
        got = {r.conv_id: tuple(r[c] for c in VERDICT) for r in conversations.repair_conversations(conversations.damage(df)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {c: brute.conversation(rows) for c, rows in brute.damaged(talks()).items() if rows}
    assert got.keys() == want.keys()
    for c, v in want.items():
        assert got[c] == v, c


def test_repaired_rows_follow_the_pattern(spark):
    df = spark.createDataFrame(talks(), TALK)
    out = {}
    for r in conversations.repaired_rows(df).orderBy("conv_id", "position").collect():
        out.setdefault(r.conv_id, []).append(r)
    found = {r.conv_id: r for r in conversations.repair_conversations(df).collect()}
    import re

    for c, r in found.items():
        rows = out.get(c, [])
        assert [x.position for x in rows] == list(range(len(rows)))
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[0] for x in rows))
        assert [x.edit for x in rows] == [e for e in r.audit if e != "D"]
        assert brute.sha("\n".join(f"{x.role}:{x.text}" for x in rows)) == r.repaired_sha256


def test_grammar_rules_do_not_change_the_matrices():
    rnd = random.Random(2)
    some = ["".join(rnd.choice(conversations.SYMBOLS) for _ in range(rnd.randint(1, 30))) for _ in range(200)] + ["ua" * 300, "u" * 301, "suaua"]
    plain = lambda ms: [{k: (c, conversations.rope_text(a)) for k, (c, a) in m.items()} for m in ms]
    assert plain(conversations.sequence_matrices(some)) == plain(conversations.sequence_matrices(some, 0))
    _, rules = conversations.re_pair(some)
    assert len(rules) > 20


def test_conversation_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[c] for c in VERDICT) for r in QUERIES["op11_conversation_repair"](spark, sf_small).collect()}
    assert got == {c: brute.conversation(r) for c, r in brute.damaged(rows).items()}


# --- 12 ---


def chatter():
    rnd = random.Random(8)
    words = ["new", "york", "city", "the", "of", "a", "it's", "É", "über", "日本", "x", "w1", "w2", "w3", "w4"]
    rows = [(None, None), ("en", ""), ("en", " \t\n., "), ("xx", "only once")]
    for i in range(150):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " New York City ", "\r"]) for _ in range(rnd.randint(1, 60)))
        rows.append((rnd.choice(["en", "en", "en", "de", None, "a language"]), text))
    return rows + [("en", "new york city " * 3000), ("long", "w" * 3000 + " " + "v" * 700 + " z." ), *[("long", "w" * 3000 + " " + "v" * 700)] * 12]


PHRASE = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize(("tally", "sent"), [(1, 1), (64, 300), (1 << 19, 1 << 20)])
def test_hash_counts_are_shuffled_as_ranges(spark, monkeypatch, tally, sent):
    """All hashes that occur often enough, with exact counts, and the words of each language; what is
    shuffled is a row a range of hashes and batch at most, not a row a hash."""
    monkeypatch.setattr(collocations, "_TALLY", tally)
    monkeypatch.setattr(collocations, "_SENT", sent)
    rnd = random.Random(3)
    texts = [(lang, " ".join(f"w{rnd.randrange(400)}" for _ in range(300))) for lang in ("de", "en", "de") * 5] + [("en", ""), ("fr", " . ")]
    df = spark.createDataFrame(texts, "lang string, text string").repartition(3).selectExpr("lang", "cast(text AS binary) AS text")
    counts = collocations._hash_counts(df, 1, [], 10)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and plan.count("Exchange hashpartitioning(at#") == 1
    want, words = Counter(), Counter()
    for lang, text in texts:
        chunk = collocations.Chunk([text.encode()])
        want.update(chunk.hashes(lang, 1).view(np.int64).tolist())
        words[lang] += len(text.replace(".", "").split())
    rows = counts.collect()
    assert sorted((r.h, r.n) for r in rows if r.lang is None) == sorted((h, n) for h, n in want.items() if n >= 10)
    assert sorted((r.lang, r.n) for r in rows if r.lang) == sorted((lang, n) for lang, n in words.items() if n)


@pytest.mark.parametrize("shard_bytes", [12 << 20, 3000])
def test_collocations(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(collocations, "SHARD_BYTES", shard_bytes)
    df = clashing(spark.createDataFrame(chatter(), "lang string, text string").repartition(3))
    for top in (2000, 5):
        got = [tuple(r[c] for c in PHRASE) for r in collocations.mine_phrases(df, top=top).collect()]
        assert sorted(got) == sorted(brute.collocations(chatter(), top))


def test_scores_are_exact_beyond_64_bits(spark):
    f = {"a": 3_000_000_000_007, "b": 2_999_999_999_999, "a b": 2_999_999_999_998}
    counts = spark.createDataFrame([("en", k.count(" ") + 1, k, v) for k, v in f.items()], "lang string, words int, phrase string, f long")
    (r,) = collocations.score_phrases(counts).collect()
    assert r.score == 1000000 * f["a b"] ** 2 // (f["a"] * f["b"])


def test_trie_against_a_dictionary():
    rnd = random.Random(1)
    phrases = sorted({" ".join(rnd.choice(["ab", "abc", "b", "cab", "é", "\x01"]) for _ in range(rnd.randint(1, 3))).encode() for _ in range(300)})
    texts = [" ".join(rnd.choice(["ab", "abc", "b", "cab", "é", "\x01", "zz", ",", "."]) for _ in range(80)).encode() for _ in range(20)]
    count = Counter()
    for t in texts:
        for piece in t.replace(b".", b",").split(b","):
            words = piece.split(b" ")
            words = [w for w in words if w]
            count.update(b" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    trie = collocations.build_trie(["de"] * 3 + ["en"] * len(phrases), phrases[:3] + phrases)
    chunk = collocations.Chunk(texts)
    assert trie.counts("en", chunk, chunk.begin).tolist() == [0, 0, 0] + [count[p] for p in phrases]
    assert trie.counts("fr", chunk, chunk.begin).sum() == 0


def test_phrases_given_lately_are_not_given_again():
    a, b = (np.array(x, np.uint64) for x in ([1, 5, 1, 9, 1], [1, 1, 1, 1, 2]))  # 1, 5 and 9 take one place
    given = collocations.Given(slots=4)
    first = given.others(a, b)
    assert sorted({*zip(a[first].tolist(), b[first].tolist())}) == [(1, 1), (1, 2), (5, 1), (9, 1)]
    again = given.others(a, b)  # only the last one there is known
    assert len({*zip(a[again].tolist(), b[again].tolist())}) == 3 and len(collocations.Given().others(a[:0], b[:0])) == 0
    wide = collocations.Given()
    assert len(wide.others(a[:4], b[:4])) == 3 and len(wide.others(a[:4], b[:4])) == 0


# --- 13 ---


def letters():
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)] + ["über", "日本", "😀"]
    words = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    base = words(300)
    rows = [(i, words(rnd.randint(0, 400))) for i in range(40)]
    rows += [(100, base), (101, base), (101, base + "!"), (101, base), (102, None), (103, ""), (104, "a"), (105, "la " * 700), (106, "x" * 3000), (107, words(9000)), (None, "no id"), (None, base)]
    return rows


FIELDS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def in_order(rows):
    import xxhash

    signed = lambda t, seed: (lambda h: h - (h >> 63 << 64))(xxhash.xxh64_intdigest(t.encode(), seed))
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1] or "", 42)))


def test_neighbours(spark):
    df = clashing(spark.createDataFrame(letters(), "doc_id long, text string").repartition(4))
    got = [(r.doc_id, *(r[c] for c in FIELDS)) for r in piecewise.edited_neighbours(df).collect()]
    rows = in_order(letters())
    want = [(d, *x) for (d, _), x in zip(rows, brute.neighbours([t for _, t in rows]))]
    assert Counter(got) == Counter(want)
    same = {r[1:4] for r in got if r[0] in (100, 101)}
    assert len({x[2] for x in same}) == 2


def test_near_texts_are_nearer_than_others(spark):
    rows = [r for r in letters() if r[0] is not None and r[0] < 40 and len(r[1]) > 400]
    got = piecewise.edited_neighbours(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.near_edited > 0.45 for r in got) and all(r.near_next < 0.2 for r in got)


def test_fingerprints_and_pairs(spark):
    df = spark.createDataFrame(letters(), "doc_id long, text string")
    prints = piecewise.fingerprint_texts(df).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in prints) == Counter((d, brute.piecewise(t or "")) for d, t in letters())
    made = [(a.fingerprint, b.fingerprint) for a, b in zip(prints, prints[5:])] + [(None, "0::"), ("0::", "0::")]
    out = piecewise.compare_fingerprints(spark.createDataFrame(made, "left string, right string")).collect()
    assert [r.likeness for r in out] == [None if a is None else brute.likeness(a, b) for a, b in made]


def test_fingerprint_query(spark, sf_small):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect())
    rows = rows[:60]  # the plain version is slow; the query is compared on the same rows
    want = {d: x[:4] for (d, _), x in zip(rows[:-1], brute.neighbours([t for _, t in rows]))}
    got = {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in QUERIES["op13_fingerprints"](spark, sf_small).collect()}
    assert {d: got[d] for d in want} == want


# --- all ---


def test_empty_tables(spark):
    talk = spark.createDataFrame([], TALK)
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    frames = [
        conversations.repair_conversations(conversations.damage(talk)), conversations.repaired_rows(talk), collocations.mine_phrases(docs),
        piecewise.edited_neighbours(docs), piecewise.fingerprint_texts(docs),
    ]
    assert all(f.count() == 0 for f in frames)
    nulls = spark.createDataFrame([(None, None, None)] * 3, docs.schema)
    assert collocations.mine_phrases(nulls).count() == 0 and piecewise.edited_neighbours(nulls).count() == 3
