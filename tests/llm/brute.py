"""Plain single-machine versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), failed


def simhash(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash_components(docs):
    """docs: {doc_id: text} -> {doc_id: (fingerprint hex, component)}."""
    fps = {d: simhash(t) for d, t in docs.items()}
    ids = sorted(fps)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 2]
    roots = components(ids, links)
    return {d: (f"{fps[d]:016x}", roots[d]) for d in ids}


def embedding_links(rows, threshold=0.93):
    """rows: (vec_id, vector, label) -> {vec_id: (n_links, component)}."""
    usable = []
    for v, e, label in rows:
        a = None if e is None or any(x is None for x in e) else np.array(e, np.float64)
        usable.append(a if label is not None and a is not None and len(a) and np.isfinite(a).all() and a.any() else None)
    n, links = Counter(), []
    for i, (v, _, la) in enumerate(rows):
        for j in range(i):
            w, _, lb = rows[j]
            if usable[i] is not None and usable[j] is not None and la == lb and len(usable[i]) == len(usable[j]):
                if usable[i] @ usable[j] / (np.linalg.norm(usable[i]) * np.linalg.norm(usable[j])) >= threshold:
                    n[v] += 1
                    n[w] += 1
                    links.append((v, w))
    roots = components([r[0] for r in rows], links)
    return {r[0]: (n[r[0]], roots[r[0]]) for r in rows}


ASSIGN = re.compile(r"""(?a:(?i:(password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = (("assign", ASSIGN, 2, 8), ("access", re.compile("(AKIA[A-Z0-9]+)"), 1, 16), ("hex", re.compile("([0-9a-f]+)"), 1, 32))


def secrets(text):
    found = []
    for rank, (kind, pattern, group, least) in enumerate(KINDS):
        found += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    found.sort()
    counts = Counter(f[2] for f in found)
    listed = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in found)
    return *(counts[k] for k, *_ in KINDS), sha(listed), found


def substrings(texts, window=35):
    """list of texts -> list of (n_words, n_removed, kept sha)."""
    words = [WORD.findall(t or "") for t in texts]
    starts = defaultdict(list)
    for d, w in enumerate(words):
        for i in range(len(w) - window + 1):
            starts[tuple(w[i : i + window])].append((d, i))
    gone = [set() for _ in texts]
    for places in starts.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + window))
    return [(len(w), len(g), sha(" ".join(x for i, x in enumerate(w) if i not in g))) for w, g in zip(words, gone)]


def lines(docs, min_chars=20, min_docs=3):
    """list of (doc_id, text) -> list of (n_lines, n_dropped, kept sha)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = [(d, (t or "").split("\n")) for d, t in docs]
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(lower)
    holders = defaultdict(list)
    for d, ls in split:
        for k in {key(x) for x in ls}:
            holders[k].append(d)
    out = []
    for d, ls in split:
        kept = []
        for x in ls:
            k = key(x)
            some = [h for h in holders[k] if h is not None]
            last = max(some) if some else None
            if not (len(k) >= min_chars and len(holders[k]) >= min_docs and d != last):
                kept.append(x)
        out.append((len(ls), len(ls) - len(kept), sha("\n".join(kept))))
    return out


def pieces(text, library, capacity=2048):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
    return [(i, s, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for i, s in enumerate(range(0, len(ids), capacity)) for p in [ids[s : s + capacity]]]


def damaged(rows):
    """rows: (conv, turn, role, text) -> {conv: rows after damage, in order}."""
    said = lambda x: " " if x is None else str(x)
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = said(role), said(text)
        fate = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out[conv] += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return {c: sorted(out[c], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c in {r[0] for r in rows}}


def conversation(rows):
    """rows in order -> (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired sha): all edits of
    all rows tried at every place of the pattern."""
    follows, place = {"": "u", "s": "u", "u": "a", "a": "u"}, {"s": "s", "u": "u", "a": "a"}
    name = {"u": "user", "a": "assistant"}
    known = [t for t, *_ in rows if t is not None]
    faults, seen = [], set()
    for _, role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {"": (0, "")}

    def offer(into, key, value):
        if key not in into or value < into[key]:
            into[key] = value

    def insert(held):
        held = dict(held)
        for _ in range(3):
            for at, (cost, audit) in list(held.items()):
                offer(held, follows[at], (cost + 5, audit + "I"))
        return held

    for (_, role, _), fault in zip(rows, faults):
        after = {}
        for at, (cost, audit) in insert(best).items():
            offer(after, at, (cost + 2, audit + "D"))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                offer(after, follows[at], (cost + 1 + more, audit + "R"))
                if place.get(role[:1]) == follows[at] or role[:1] == "s" and at == "":
                    offer(after, role[:1], (cost + more, audit + "K"))
        best = after
    cost, audit = min(v for k, v in insert(best).items() if k in ("", "a"))
    out, at, left = [], "", iter(rows)
    for edit in audit:
        if edit == "I":
            at = follows[at]
            out.append(f"{name[at]}:")
            continue
        _, role, text = next(left)
        if edit == "R":
            at = follows[at]
            out.append(f"{name[at]}:{text}")
        elif edit == "K":
            at = role[:1]
            out.append(f"{role}:{text}")
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(out))


def collocations(docs, top=2000, least=10):
    """docs: (lang, text) -> rows (lang, rank, phrase, a, l, r, n, score)."""
    counts = defaultdict(Counter)
    for lang, text in docs:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                counts["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = []
        for p, a in f.items():
            if len(p) > 1 and a >= least:
                score, _, left, right = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                longer = [c for q, c in f.items() if len(q) > len(p) and c >= least and any(q[i : i + len(p)] == p for i in range(len(q)))] if a < 5000 else []
                if not any(100 * c >= 50 * a for c in longer):
                    found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n, -score) for i, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return out


def piecewise(text):
    """The fingerprint of a text, byte by byte."""
    raw, hashes = text.encode(), []
    for i in range(len(raw)):
        h = 0
        for j in range(min(8, i + 1)):
            v = (raw[i - j] + 1) * 0x9E3779B1 & 0xFFFFFFFF
            h += (v ^ v >> 15) * pow(0x01000193, j, 1 << 32)
        h &= 0xFFFFFFFF
        h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
        hashes.append(h ^ h >> 13)

    def cut(k):
        parts, begin = [], 0
        for i, h in enumerate(hashes, 1):
            if h % (1 << k) == 0 or i - begin == 8 << k or i == len(raw):
                parts.append(raw[begin:i])
                begin = i
        return parts

    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    sign = lambda parts: "".join(letters[xxhash.xxh32_intdigest(p) >> s & 63] for p in parts for s in (12, 6, 0))
    k = next(k for k in range(99) if len(cut(k)) <= 64)
    return f"{k}:{sign(cut(k))}:{sign(cut(k + 1))}"


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def likeness(one, other):
    parts = [{int(f.split(":")[0]) + i: s for i, s in enumerate(f.split(":")[1:])} for f in (one, other)]
    split = lambda s: [s[i : i + 3] for i in range(0, len(s), 3)]
    scores = [float(one == other)]
    for k in parts[0].keys() & parts[1].keys():
        a, b = split(parts[0][k]), split(parts[1][k])
        if a and b:
            scores.append(1 - edit_distance(a, b) / max(len(a), len(b)))
    return max(scores)


def neighbours(texts):
    """texts in order -> (n_chars, edited sha, fingerprint, edited fingerprint, near_edited, near_next)."""
    texts = [t or "" for t in texts]
    prints = [piecewise(t) for t in texts]
    out = []
    for i, t in enumerate(texts):
        j, m = (i + 1) % len(texts), len(t) // 4
        edited = t[: len(t) - m] + texts[j][:m]
        changed = piecewise(edited)
        out.append((len(t), sha(edited), prints[i], changed, likeness(prints[i], changed), likeness(prints[i], prints[j])))
    return out


def licenses(text, known, clauses, clause_words, threshold=0.8):
    """(license, dice) of the finds that stay in a text; known: what the operator asks of a run."""
    words = re.findall("[a-z0-9]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    runs = []
    for k in known:
        if len(set(pairs) & set(k["b"])) < k["least"]:
            continue
        hits, found = [i for i, p in enumerate(pairs) if p in k["b"]], []
        for n, a in enumerate(hits):
            best = None
            for shared, b in enumerate(hits[n + k["need"] - 1 :], k["need"]):
                held, ahead = words[a : b + 2], words[b + 2 : b + 2 + clause_words]
                two, three = (c in ahead for c in clauses)
                fits = not set(k["tell"]) - set(held) and not set(held) & set(k["others"])
                fits = fits and (k["clauses"] != 3 or three or not two) and (k["clauses"] != 2 or not three)
                if b - a < k["longest"] and fits:
                    shared = min(shared, k["size"])
                    run = 2.0 * shared / (b - a + 1 + k["size"]), -a, -b, shared, a, b, k["license"]
                    best = max(best or run, run) if run[0] >= threshold else best
            found += [best] if best else []
        over = lambda x, y: x[4] <= y[5] and y[4] <= x[5]
        runs += [r for r in found if not any(over(o, r) and o > r for o in found)]
    kept = []
    for r in sorted(runs, key=lambda r: (r[3], r[0], r[4], r[5], r[6]), reverse=True):
        if not any(o[6] != r[6] and over(o, r) and (o[3] > r[3] or o[0] > r[0]) for o in kept):
            kept.append(r)
    best = {}
    for r in kept:
        best[r[6]] = max(best.get(r[6], 0), r[0])
    if len(best) > 1:
        best.pop("proprietary", None)
    return sorted(best.items())
