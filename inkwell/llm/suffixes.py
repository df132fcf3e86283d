"""Suffix sorting by grouping suffixes of a common Lyndon prefix, and removal of repeated byte strings with it."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import BYTES, Kind, Runs, ranges, repeated_spans

SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def suffix_array(text: list[int]) -> list[int]:
    """Order of all suffixes of text, a list of integers whose last one is smaller than any other.

    Two phases, linear but for sorting a group by place. First, groups of suffixes (by first symbol) are processed
    in descending order: each member's pointer to the nearest suffix before it in a lower group is found by
    following the pointers known so far, and the suffixes pointed to move, by how many members point to them,
    into new groups right after their own; a group's suffixes then share their longest Lyndon prefix. Second,
    suffixes are emitted: from each sorted suffix the pointers lead to the next ones, each placed first of what is
    left of its group. No symbols are renamed and nothing is sorted again."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    start = [0] * n  # of each suffix's group
    place = [0] * n
    size = [0] * n  # by a group's start
    s = 0
    for k, i in enumerate(order):
        if k and text[i] != text[order[k - 1]]:
            s = k
        start[i], place[i] = s, k
        size[s] += 1
    before = [-1] * n
    end = n - 1
    while end >= 0:
        g = start[order[end]]
        if g == end:  # one suffix: the common case
            i = order[end]
            j = i - 1
            while j >= 0 and start[j] >= g:
                j = before[j]
            before[i] = j
            if j >= 0:
                h = start[j]
                z = size[h] - 1
                if z:
                    e = h + z
                    p, other = place[j], order[e]
                    order[p], order[e] = other, j
                    place[other], place[j] = p, e
                    size[h], size[e], start[j] = z, 1, e
            end = g - 1
            continue
        members = sorted(order[g : end + 1])
        pointed: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and start[j] >= g:
                j = before[j]
            before[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        levels: dict[int, list[int]] = {}
        for j, c in pointed.items():
            levels.setdefault(c, []).append(j)
        for c in sorted(levels, reverse=True):
            touched: dict[int, int] = {}
            for j in levels[c]:
                h = start[j]
                size[h] -= 1
                e = h + size[h]
                p, other = place[j], order[e]
                order[p], order[e] = other, j
                place[other], place[j] = p, e
                touched[h] = touched.get(h, 0) + 1
            for h, k in touched.items():
                e = h + size[h]
                if e != h:
                    for p in range(e, e + k):
                        start[order[p]] = e
                size[e] = k
        end = g - 1
    out = [-1] * n
    nxt = list(range(n))  # first free place of the group that starts here
    done = bytearray(n)
    out[0] = n - 1
    done[n - 1] = 1
    nxt[0] = 1
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            g = start[j]
            out[nxt[g]] = j
            nxt[g] += 1
            done[j] = 1
            j = before[j]
    return out


def suffix_arrays(symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """suffix_array of many texts at once, whose symbols stand in a row: the places of each text's sorted suffixes,
    counted over the row. All texts take the same step at a time: in the first phase their next lower group, in the
    second their next emitted suffix, so that numpy works on as many elements as there are texts."""
    n, m = sizes.astype(np.int64), len(sizes)
    begin = np.cumsum(n + 1) - n  # a pad before each text ends the pointers' chains
    total = int(n.sum()) + m
    text = np.full(total, -1, np.int64)
    where = np.ones(total, bool)
    where[begin - 1] = False
    at = np.flatnonzero(where)
    text[at] = symbols
    owner = np.repeat(np.arange(m), n)
    order = np.zeros(total, np.int64)
    order[at] = at[np.argsort(owner * (int(symbols.max()) + 1) + symbols, kind="stable")]
    place = np.zeros(total, np.int64)
    place[order[at]] = at
    first = np.zeros(total, bool)
    first[at] = (text[order[at]] != text[order[at - 1]]) | ~where[at - 1]
    heads = np.flatnonzero(first)
    size = np.zeros(total, np.int64)
    start = np.full(total, -1, np.int64)
    ends = np.concatenate([heads[1:], [total]])
    ends = np.where(where[ends - 1], ends, ends - 1)
    size[heads] = ends - heads
    start[order[at]] = heads[np.cumsum(first)[at] - 1]
    before = np.zeros(total, np.int64)

    def lift(t: np.ndarray) -> None:
        """Moves these suffixes, which equally many members of the present groups point to, into groups of their own."""
        h = start[t]
        by = np.argsort(h, kind="stable")
        t, h = t[by], h[by]
        new = np.concatenate([[True], h[1:] != h[:-1]])
        head = np.flatnonzero(new)
        k = np.diff(np.concatenate([head, [len(t)]]))
        rank = np.arange(len(t)) - np.repeat(head, k)
        for r in range(int(k.max())):
            own = rank == r if r or len(head) != len(t) else slice(None)
            swap(t[own], h[own])
        u = h[head]
        e = u + size[u]
        start[t] = np.repeat(e, k)
        size[e] = k

    def swap(t: np.ndarray, h: np.ndarray) -> None:
        size[h] -= 1
        e = h + size[h]
        p, other = place[t], order[e]
        order[p], order[e] = other, t
        place[other], place[t] = p, e

    def follow(j: np.ndarray, g: np.ndarray) -> None:
        """From each j, along the pointers known so far, to a group that isn't above g."""
        high = np.flatnonzero(start[j] > g)
        while len(high):
            to = before[j[high]]
            j[high] = to
            high = high[start[to] > g[high]]

    end, low = begin + n - 1, begin
    while len(end):
        i = order[end]
        g = start[i]
        alone = g == end
        if alone.all():
            one, h = i, g
        else:
            one, h = i[alone], g[alone]
            many, count = g[~alone], (end - g)[~alone] + 1
            own = np.repeat(many, count)
            i = order[ranges(many, count)]
            j = i - 1
            follow(j, own)
            before[i] = j
            same = np.flatnonzero(start[j] == own)
            while len(same):  # a pointer to a member of the group leads on to what that one points to
                j[same] = before[j[same]]
                before[i[same]] = j[same]
                same = same[start[j[same]] == own[same]]
            t = np.sort(j[start[j] >= 0])
            if len(t):
                head = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
                c, t = np.diff(np.concatenate([head, [len(t)]])), t[head]
                for level in range(int(c.max()), 0, -1):
                    if (at_level := c == level).any():
                        lift(t[at_level])
        if len(one):
            j = one - 1
            follow(j, h)
            before[one] = j
            h = start[j]
            some = np.flatnonzero((h >= 0) & (size[h] > 1))
            if len(some):
                t, h = j[some], h[some]
                swap(t, h)
                e = h + size[h]
                start[t], size[e] = e, 1
        end = g - 1
        if (end < low).any():
            keep = end >= low
            end, low = end[keep], low[keep]

    out = np.zeros(total, np.int64)
    done = ~where
    nxt = np.arange(total)
    k, stop = begin.copy(), begin + n
    out[k] = stop - 1
    done[stop - 1] = True
    nxt[begin] += 1
    while len(k):
        j = out[k] - 1
        j = j[~done[j]]
        while len(j):
            g = start[j]
            to = nxt[g]
            out[to] = j
            nxt[g] = to + 1
            done[j] = True
            j = before[j]
            j = j[~done[j]]
        k = k + 1
        if (k >= stop).any():
            keep = k < stop
            k, stop = k[keep], stop[keep]
    return out[at] - np.repeat(np.arange(1, m + 1), n)


#: Texts are sorted together, about TOGETHER symbols at a time, if they have EVEN times the symbols of their longest one, which tells the number of
#: steps; the others are sorted alone.
TOGETHER, EVEN = 1 << 20, 80


def sorted_suffixes(symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of the sorted suffixes of each text in turn."""
    out = np.zeros(len(symbols), np.int64)
    begin = np.cumsum(sizes) - sizes
    by = np.argsort(sizes, kind="stable")  # texts of like sizes take equally many steps
    reach = np.cumsum(sizes[by])
    at = 0
    while at < len(by):
        before = reach[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(reach, before + TOGETHER, side="right")))
        worth = np.flatnonzero(reach[at:to] - before >= EVEN * sizes[by[at:to]])
        if not len(worth):
            break
        to = at + int(worth[-1]) + 1
        own = by[at:to]
        where = ranges(begin[own], sizes[own])
        out[where] = where[suffix_arrays(symbols[where].astype(np.int64), sizes[own])]
        at = to
    for k in by[at:]:
        s = slice(begin[k], begin[k] + sizes[k])
        out[s] = np.array(suffix_array(symbols[s].tolist())) + begin[k]
    return out


def resolve_by_suffixes(runs: Runs, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of a block's runs that also start earlier, by a suffix array of each anchor's runs.

    An anchor's text is its different runs, byte for byte, each after a mark. In the sorted suffixes, equal windows
    are neighbours with a common prefix of a whole window, which is compared; such an interval's least place in the
    corpus is the first start, and all others are repeats. A run that occurs several times stands in the text once,
    with its first place; its later places are repeats of that one. A text of one run isn't sorted: the windows of a
    run have their anchor in different places, so no two of them are equal."""
    w = kind.window
    turn = np.lexsort((runs.start, runs.place))
    code: dict[bytes, int] = {}
    of = np.zeros(len(runs.raw), np.int64)  # each run's number among the different ones
    of[turn] = [code.setdefault(runs.raw[i], len(code)) for i in turn.tolist()]
    first = np.zeros(len(code), np.int64)
    first[of[turn[::-1]]] = turn[::-1]
    again = np.ones(len(of), bool)
    again[first] = False
    texts = list(code)
    by = np.argsort(runs.anchor[first], kind="stable")
    text_of = np.cumsum(np.concatenate([[0], np.diff(runs.anchor[first][by]) != 0])[: len(by)]).astype(np.int64)
    by = by[np.bincount(text_of)[text_of] > 1] if len(by) else by
    r = np.flatnonzero(again)
    if not len(by):
        return r, runs.start[r], runs.start[r] + runs.windows[r] - 1
    anchor, first = runs.anchor[first][by], first[by]
    raw = b"".join([texts[i] for i in by.tolist()])
    length = np.fromiter((len(texts[i]) for i in by.tolist()), np.int64, len(by))
    data = np.frombuffer(raw + bytes(8), np.uint8)
    begin = np.cumsum(length) - length
    # symbols: a mark (1) before each run, bytes from 2 on, and the least symbol (0) at the end of each anchor's text
    new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    text_of = np.cumsum(new) - 1
    lead = begin + np.arange(len(length)) + text_of + 1  # the first byte's place in the symbols
    sizes = np.bincount(text_of, length + 1).astype(np.int64) + 1
    symbols = np.ones(int(sizes.sum()), np.int16)
    symbols[np.cumsum(sizes) - 1] = 0
    place = ranges(lead, length)
    symbols[place] = data[: len(place)].astype(np.int16) + 2
    run_at = np.full(len(symbols), -1, np.int32)  # of places where a window begins: its run
    windows = runs.windows[first]
    starts = ranges(lead, windows)
    run_at[starts] = np.repeat(np.arange(len(first)), windows)
    order = sorted_suffixes(symbols, sizes)
    order = order[run_at[order] >= 0]
    run = run_at[order]
    byte = begin[run] + (order - lead[run])
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    same = text_of[run[1:]] == text_of[run[:-1]]
    for k in [*range(0, w - 7, 8), w - 8]:
        left = np.flatnonzero(same)
        same[left[words[byte[left] + k] != words[byte[left + 1] + k]]] = False
    key = (runs.place[first][run] << 32) + runs.start[first][run] + (order - lead[run])
    head = np.flatnonzero(np.concatenate([[True], ~same]))
    repeated = key > np.repeat(np.minimum.reduceat(key, head), np.diff(np.concatenate([head, [len(key)]]))) if len(key) else np.zeros(0, bool)
    own, at = first[run[repeated]], key[repeated] & 0xFFFFFFFF
    return np.concatenate([r, own]), np.concatenate([runs.start[r], at]), np.concatenate([runs.start[r] + runs.windows[r] - 1, at])


def cut_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    if not spans:
        return raw
    out, at = [], 0
    for s, e in spans:
        out.append(raw[at:s])
        at = e
    return b"".join([*out, raw[at:]])


def remove_repeats(docs: DataFrame, **options: int) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans and the SHA-256 of what is left once every byte is removed that a
    100-byte string covers which also starts earlier.

    A null text is empty; texts under 100 bytes lose nothing. Rows equal in doc_id and text count as one document
    and get its result each; rows of one id with different texts are ordered by a hash of the text; null ids come
    last. An empty table gives an empty result; extra columns are not read."""

    def finish(rows: pd.DataFrame, spans: list[list[tuple[int, int]]]) -> pd.DataFrame:
        out = []
        for doc, text, own in zip(rows["doc_id"], rows["text"], spans):
            raw = text.encode() if isinstance(text, str) else b""
            out.append((doc, len(raw), sum(e - s for s, e in own), len(own), hashlib.sha256(cut_bytes(raw, own)).hexdigest()))
        return pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return repeated_spans(docs.select("doc_id", "text"), BYTES, resolve_by_suffixes, finish, SCHEMA, **options)


def without_repeats(docs: DataFrame, **options: int) -> DataFrame:
    """docs with the repeated bytes gone from text (a character cut in two goes whole) and n_chars counted anew;
    every row and column stays, whatever the other columns are called. A null text stays null."""
    names, doc, text, chars = docs.columns, docs.columns.index("doc_id"), docs.columns.index("text"), "n_chars"
    given = ["doc_id" if i == doc else "text" if i == text else f"c{i}" for i in range(len(names))]
    count = given[names.index(chars)] if chars in names else None
    # beside a null, pandas holds whole numbers as doubles: longs, which may not fit, go as text
    kinds = {g: f.dataType.simpleString() for g, f in zip(given, docs.schema)} | {"doc_id": "bigint"}
    long, whole = [g for g, k in kinds.items() if k == "bigint" and g != "doc_id"], [g for g, k in kinds.items() if k in ("int", "smallint", "tinyint")]
    schema = ", ".join(f"{g} {'string' if g in long else k}" for g, k in kinds.items())

    def finish(rows: pd.DataFrame, spans: list[list[tuple[int, int]]]) -> pd.DataFrame:
        rows = rows[given].copy()
        texts = [cut_bytes(t.encode(), own).decode(errors="ignore") if isinstance(t, str) else None for t, own in zip(rows["text"], spans)]
        rows["text"] = pd.Series(texts, index=rows.index, dtype=object)
        if count:
            sizes = [len(t) if t is not None else 0 for t in texts]
            rows[count] = [str(k) for k in sizes] if count in long else sizes
        for c in whole:
            rows[c] = rows[c].astype("Int64")
        return rows

    plain = docs.toDF(*given).withColumns({"doc_id": F.col("doc_id").cast("bigint")} | {g: F.col(g).cast("string") for g in long})
    out = repeated_spans(plain, BYTES, resolve_by_suffixes, finish, schema, **options).withColumns({g: F.col(g).cast("bigint") for g in long})
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc].dataType)).toDF(*names)
