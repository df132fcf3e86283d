"""A small corpus with every odd case, and brute-force versions of the contracts."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, bucket string"


def corpus(n: int = 60, seed: int = 1) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, bucket): copies, near copies, shared passages, null, empty, blank, short,
    one-word and long texts, non-ASCII, ties; the last column's name is one that operators use inside."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(70))
    texts: list[str | None] = [None, "", "   \n", "word", "Ünïcödé wörds, ßtraße. 漢字", "a b", "A B", "x" * 250, "la " * 400]
    while len(texts) < n:
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 150))]
        k = rng.random()
        if k < 0.2:
            words[rng.randint(0, len(words)) : 0] = passage.split()
        if k > 0.8 and len(texts) > 15:
            old = texts[rng.randint(9, len(texts) - 1)].split()
            words = [rng.choice(vocabulary) if rng.random() < 0.03 else w for w in old]
        texts.append(" ".join(w + rng.choice(["", "", "", ".", "\n"]) for w in words))
    texts += [texts[10], texts[10], texts[12].upper()]
    return [(i * 3 + 1, t, ["en", "de", None][i % 3], [None, "s1", "s2", "s3"][min(3, i % 7)], len(t or ""), "b") for i, t in enumerate(texts)]


def ordered(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: r[0])


def without_repeats(rows: list[tuple], window: int, words: bool) -> dict[int, tuple]:
    """doc_id -> (symbols, removed, spans, SHA-256 of what is left)."""
    seen, out = set(), {}
    for doc, text, *_ in ordered(rows):
        raw = (text or "").encode()
        symbols = WORD.findall(text or "") if words else raw
        mark = bytearray(len(symbols))
        for s in range(len(symbols) - window + 1):
            w = tuple(symbols[s : s + window])
            if w in seen:
                mark[s : s + window] = b"x" * window
            seen.add(w)
        left = [x for x, m in zip(symbols, mark) if not m]
        kept = " ".join(left).encode() if words else bytes(left)
        out[doc] = (len(symbols), sum(map(bool, mark)), len(re.findall(rb"x+", bytes(mark))), hashlib.sha256(kept).hexdigest())
    return out


def near_groups(rows: list[tuple], words: int, percent: int = 80) -> dict[int, tuple]:
    """doc_id -> (shingles, component)."""
    sets = {}
    for doc, text, *_ in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets[doc] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            k = len(sets[a] & sets[b])
            if k and 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def base_counts(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    hit = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)
