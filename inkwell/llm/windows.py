"""Repeated windows of a fixed number of symbols over a whole corpus: which of them start earlier elsewhere.

A symbol is a byte or a word. Every window has one anchor, the least hash among its k-grams (the last of equal ones),
so equal windows have equal anchors in equal places. Windows of a document with the same anchor are a run of
consecutive starts. Hashes of anchors only decide where runs meet; which windows are equal is found from the runs'
own symbols, by the operator's method (`resolve`). The corpus is never shuffled window by window:

1. runs: each batch of documents sends, per bucket of anchor hashes, packed arrays of its runs (anchor, document,
   place). An anchor with over BATCH_HOT runs in a batch is resolved there first, and only windows that the batch
   has no earlier start of are sent on: a passage of very many documents is aggregated before the shuffle.
2. a bucket keeps the runs whose anchor stands in two places or more, and requests their symbols.
3. documents answer with the runs' bytes, sent to blocks of anchors. An anchor with more than HOT runs is salted: its
   windows are dealt by their second least hash too, which equal windows share.
4. a block resolves its runs.
5. documents gather their repeated spans.

A document's place in the order is (doc_id, 64-bit hash of its text): equal rows count as one document, null ids come
last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_VALUE, Rolling, chunks, give_back, let_go, long_ids, mix, text_ids, with_text_ids, words_of

HOT, BATCH_HOT = 1024, 64
NULL_ID = np.iinfo(np.int64).max
MESSAGE = "bucket int, kind int, data binary"
RUNS, SPANS, WANTED, SYMBOLS = range(4)
FIELDS: dict[int, str] = {
    RUNS: "u8 i8 i8 u4 u1 u1",  # anchor, document, text hash, first start, anchor's offset, windows - 1
    SPANS: "i8 i8 u4 u4",  # document, text hash, start, end
    WANTED: "u8 i8 i8 u4 u1 u1 u1",  # anchor, document, text hash, first start, offset, windows - 1, salted
}


@dataclass(frozen=True)
class Kind:
    """What a symbol is, the window's length and the anchor's, in symbols."""

    name: str
    window: int
    gram: int

    def symbols(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashed symbols of all texts in a row and each text's number of them."""
        return self.places(texts)[:2]

    def places(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same, and the bytes where each symbol begins and ends, counted over the texts in a row."""
        if self.name == "bytes":
            data = np.frombuffer(b"".join(texts), np.uint8)
            at = np.arange(len(data))
            return BYTE_VALUE[data], np.fromiter(map(len, texts), np.int64, len(texts)), at, at + 1
        value, text, start, end = words_of(texts)
        base = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])[text]
        return value, np.bincount(text, minlength=len(texts)), start + base, end + base


#: What a block gets of each run: anchor, document, text hash, first start, windows - 1, bytes.
SENT = ("u8", "i8", "i8", "u4", "u1", "u4")

BYTES = Kind("bytes", 100, 24)
WORDS = Kind("words", 20, 8)


def packed(kind: int, columns: list[np.ndarray]) -> bytes:
    raw = b"".join(np.ascontiguousarray(c.astype(t, copy=False)).tobytes() for c, t in zip(columns, FIELDS[kind].split()))
    return zstandard.compress(raw, 1)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (length[0] of them), start[1], ..."""
    length = length.astype(np.int64)
    before = np.cumsum(length) - length
    return np.arange(int(length.sum())) + np.repeat(start.astype(np.int64) - before, length)


def unpacked(kind: int, blobs: list[bytes]) -> list[np.ndarray]:
    types = [np.dtype(t) for t in FIELDS[kind].split()]
    width = sum(t.itemsize for t in types)
    parts: list[list[np.ndarray]] = [[] for _ in types]
    for b in map(zstandard.decompress, blobs):
        n, at = len(b) // width, 0
        for t, p in zip(types, parts):
            p.append(np.frombuffer(b, t, n, at))
            at += n * t.itemsize
    return [np.concatenate(p) if p else np.zeros(0, t) for t, p in zip(types, parts)]


def split_by(bucket: np.ndarray, kind: int, columns: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(bucket[a]), kind, packed(kind, [c[a:b] for c in columns])


def frame(rows) -> pd.DataFrame:
    return pd.DataFrame(list(rows), columns=["bucket", "kind", "data"])


#: With ids below PRIME after the first remainder, the product stays within 63 bits in numpy and on the JVM.
PRIME, FACTOR = 2147483629, 1103515245


def bucket_of(doc: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """By id and text hash, so that rows of one id, or without one, with different texts are dealt over the buckets."""
    return (((doc.astype(np.int64) % PRIME + text.astype(np.int64) % PRIME) % PRIME * FACTOR >> 12) % n).astype(np.int32)


def joined_spans(doc: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Spans with those that touch or overlap made one."""
    if not len(doc):
        return [doc, text, start, end]
    o = np.lexsort((start, text, doc))
    doc, text, start, end = doc[o], text[o], start[o].astype(np.int64), end[o].astype(np.int64)
    new_doc = np.concatenate([[True], (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])])
    # a running maximum of ends within a document: ends are lifted by the document's number
    lift = np.cumsum(new_doc).astype(np.int64) << 33
    reach = np.maximum.accumulate(end + lift)
    new = np.concatenate([[True], start[1:] + lift[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(doc)]]) - 1
    return [doc[first], text[first], start[first], reach[last] - lift[last]]


def runs_of(symbols: np.ndarray, sizes: np.ndarray, kind: Kind) -> tuple[np.ndarray, ...]:
    """Runs of the texts whose symbols stand in a row: (text index, first start, anchor, last start) with places
    counted from the start of the text, anchor hash."""
    w, k = kind.window, kind.gram
    n = len(symbols)
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    if n < w:
        return none
    roll = Rolling(symbols)
    gram = roll.grams(k)
    bits = np.uint64(max(24, int(n).bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    key = (gram >> bits << bits) | (mask - np.arange(len(gram), dtype=np.uint64))
    span, least, have = w - k + 1, key, 1
    while 2 * have <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < span:
        least = np.minimum(least[: len(least) - (span - have)], least[span - have :])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    starts = np.maximum(sizes - w + 1, 0)
    total = int(starts.sum())
    if not total:
        return none
    text = np.repeat(np.arange(len(sizes)), starts)
    at = np.arange(total) - np.repeat(np.cumsum(starts) - starts, starts) + np.repeat(begins, starts)
    anchor = (mask - (least[at] & mask)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
    last = np.concatenate([first[1:], [total]]) - 1
    lo, hi, a, text = at[first], at[last], anchor[first], text[first]
    b = begins[text]
    return text, lo - b, a - b, hi - b, gram[a]


def by_second(gram: np.ndarray, lo: np.ndarray, a: np.ndarray, m: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs cut where their windows' second least k-gram hash changes: (run, first start, windows - 1, that hash). Places
    are indexes of gram; a window covers `span` k-grams."""
    none, parts = np.uint64(2**64 - 1), []
    step = np.arange(1, span)
    for k in range(0, len(lo), 4096):
        at, first, more = a[k : k + 4096], lo[k : k + 4096], m[k : k + 4096].astype(np.int64)
        left, right = at[:, None] - step, at[:, None] + step
        left = np.minimum.accumulate(np.where(left >= first[:, None], gram[np.maximum(left, 0)], none), axis=1)
        right = np.minimum.accumulate(np.where(right < (first + more + span)[:, None], gram[np.minimum(right, len(gram) - 1)], none), axis=1)
        run = np.repeat(np.arange(len(at)), more + 1)
        start = ranges(first, more + 1)
        back = at[run] - start
        least = np.minimum(np.where(back > 0, left[run, np.maximum(back - 1, 0)], none), np.where(back < span - 1, right[run, np.maximum(span - 2 - back, 0)], none))
        new = np.flatnonzero(np.concatenate([[True], (run[1:] != run[:-1]) | (least[1:] != least[:-1])]))
        parts.append((run[new] + k, start[new], np.diff(np.concatenate([new, [len(run)]])) - 1, least[new]))
    return tuple(np.concatenate(c) for c in zip(*parts))


def _ids(batch: pd.DataFrame) -> np.ndarray:
    """Ids, which come as text, as numbers."""
    return np.fromiter((NULL_ID if d is None or d is pd.NA else int(d) for d in batch["doc_id"]), np.int64, len(batch))


def _texts(batch: pd.DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    texts = [t.encode() if isinstance(t, str) else b"" for t in batch["text"]]
    return texts, _ids(batch), batch["th"].to_numpy(np.int64)


@dataclass
class Runs:
    """Runs that meet in a block: what a resolver gets. `place` is each run's document's rank in the order of the
    corpus, `raw` its bytes."""

    anchor: np.ndarray
    place: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    raw: list[bytes]


#: (run, first start, last start) of windows that also start earlier, in any order; ranges may go beyond the run that
#: they are given by, within its document.
Resolver = Callable[[Runs, Kind], tuple[np.ndarray, np.ndarray, np.ndarray]]


def ranked(doc: np.ndarray, text: np.ndarray) -> np.ndarray:
    order = np.lexsort((text, doc))
    new = np.concatenate([[False], (doc[order][1:] != doc[order][:-1]) | (text[order][1:] != text[order][:-1])])
    rank = np.zeros(len(doc), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def _resolved(resolve: Resolver, kind: Kind, h, d, x, lo, m, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return resolve(Runs(h, ranked(d, x), lo.astype(np.int64), m.astype(np.int64) + 1, raw), kind)


def _left(place: np.ndarray, lo: np.ndarray, m: np.ndarray, gone: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, first start, windows - 1) of what is left of runs without the starts s..e of the places `gone`."""
    count = m.astype(np.int64) + 1
    run, start = np.repeat(np.arange(len(lo)), count), ranges(lo, count)
    out = np.isin((place[run] << 32) + start, (np.repeat(gone, e - s + 1) << 32) + ranges(s, e - s + 1))
    run, start = run[~out], start[~out]
    new = np.flatnonzero(np.concatenate([[True], (run[1:] != run[:-1]) | (start[1:] != start[:-1] + 1)])) if len(run) else np.zeros(0, np.int64)
    return run[new], start[new], np.diff(np.concatenate([new, [len(run)]])) - 1


def repeated_spans(docs: DataFrame, kind: Kind, resolve: Resolver, finish: Callable, schema: str, bucket_bytes: int = 8_000_000, hot: int = HOT, batch_hot: int = BATCH_HOT) -> DataFrame:
    """docs (doc_id, text, any columns to keep) through finish(row frame, spans of each row), per bucket of documents."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(8, int(total // bucket_bytes))
    w, span = kind.window, kind.window - kind.gram + 1
    rows = docs.withColumn("th", F.xxhash64("text"))

    def spans_of(d, x, s, e) -> Iterator[tuple[int, int, bytes]]:
        spans = joined_spans(d, x, s, e)
        return split_by(bucket_of(spans[0], spans[1], n), SPANS, spans)

    def runs_in(texts: list[bytes], doc: np.ndarray, th: np.ndarray) -> pd.DataFrame:
        found, parts = [], []
        for i, j in chunks(texts, 2_000_000):
            t, lo, a, hi, h = runs_of(*kind.symbols(texts[i:j]), kind)
            found.append((h, t + i, lo, a - lo, hi - lo))
        h, t, lo, a, m = (np.concatenate(p) for p in zip(*found))
        d, x = doc[t], th[t]
        order = np.argsort(h, kind="stable")
        new = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]])) if len(h) else np.zeros(0, np.int64)
        many = np.diff(np.concatenate([new, [len(h)]])) > batch_hot
        if many.any():  # frequent anchors: resolved here, so that only windows new to this batch are sent
            often = order[np.repeat(many, np.diff(np.concatenate([new, [len(h)]])))]
            _, one = np.unique(np.stack([d[often].view(np.uint64), x[often].view(np.uint64), lo[often].astype(np.uint64)]), axis=1, return_index=True)
            often = often[np.sort(one)]  # equal rows are one document
            often = often[np.argsort(t[often], kind="stable")]
            raw: list[bytes] = []
            for i in np.unique(t[often]):
                own = often[np.searchsorted(t[often], i) : np.searchsorted(t[often], i, side="right")]
                _, _, begin, end = kind.places([texts[i]])
                raw += [texts[i][p:q] for p, q in zip(begin[lo[own]].tolist(), end[lo[own] + m[own] + w - 1].tolist())]
            run, s, e = _resolved(resolve, kind, h[often], d[often], x[often], lo[often], m[often], raw)
            parts += spans_of(d[often][run], x[often][run], s, e + w)
            place = ranked(d[often], x[often])
            r, start, more = _left(place, lo[often], m[often], place[run], s, e)
            rest = np.ones(len(h), bool)
            rest[order[np.repeat(many, np.diff(np.concatenate([new, [len(h)]])))]] = False
            o = often[r]
            h, d, x, a = (np.concatenate([v[rest], v[o]]) for v in (h, d, x, a + lo))
            lo, m = np.concatenate([lo[rest], start]), np.concatenate([m[rest], more])
            a = a - lo
        return frame([*parts, *split_by((h % np.uint64(n)).astype(np.int32), RUNS, [h, d, x, lo, a, m])])

    def find_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        held: list[tuple] = []
        for batch in batches:
            texts, doc, th = _texts(batch)
            for i, j in chunks(texts, 16_000_000):
                held.append((texts[i:j], doc[i:j], th[i:j]))
                if sum(len(t) for own, _, _ in held for t in own) > 8_000_000:
                    yield runs_in([t for own, _, _ in held for t in own], *(np.concatenate(c) for c in list(zip(*held))[1:]))
                    held = []
        if held:
            yield runs_in([t for own, _, _ in held for t in own], *(np.concatenate(c) for c in list(zip(*held))[1:]))

    def blobs(part: pd.DataFrame, kind: int) -> list[bytes]:
        return list(part["data"][part["kind"] == kind])

    def settle_runs(part: pd.DataFrame) -> pd.DataFrame:
        give_back()  # what the last group freed
        h, d, x, lo, a, m = unpacked(RUNS, blobs(part, RUNS))
        order = np.lexsort((lo, x, d, h))
        h, d, x, lo, a, m = (v[order] for v in (h, d, x, lo, a, m))
        if len(h):  # equal rows are one document
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1]) | (x[1:] != x[:-1]) | (lo[1:] != lo[:-1])])
            h, d, x, lo, a, m = (v[new] for v in (h, d, x, lo, a, m))
        _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
        size = count[inverse]
        many = size > 1  # within one run no two windows are equal: their anchor has different places in them
        want = [v[many] for v in (h, d, x, lo, a, m)] + [(size[many] > hot).astype(np.uint8)]
        passed = unpacked(SPANS, blobs(part, SPANS))
        return frame([*split_by(bucket_of(want[1], want[2], n), WANTED, want), *spans_of(*passed)])

    def answer(texts: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        give_back()  # what the last group freed
        out = list(spans_of(*unpacked(SPANS, blobs(part, SPANS))))
        h, d, x, lo, a, m, salted = unpacked(WANTED, blobs(part, WANTED))
        if not len(h):
            return frame(out)
        raw, doc, th = _texts(texts)
        place = {key: i for i, key in enumerate(zip(doc.tolist(), th.tolist()))}
        at = np.fromiter((place[key] for key in zip(d.tolist(), x.tolist())), np.int64, len(d))
        order = np.lexsort((lo, at))
        h, d, x, lo, a, m, salted, at = (v[order] for v in (h, d, x, lo.astype(np.int64), a.astype(np.int64), m, salted, at))
        asked = np.unique(at)
        for i, j in chunks([raw[k] for k in asked], 4_000_000):
            own = [raw[k] for k in asked[i:j]]
            value, sizes, begin, end = kind.places(own)
            mine = slice(np.searchsorted(at, asked[i]), np.searchsorted(at, asked[j - 1], side="right"))
            base = (np.cumsum(sizes) - sizes)[np.searchsorted(asked[i:j], at[mine])]
            hh, dd, xx, ll, aa, mm, ss = (v[mine] for v in (h, d, x, lo, a, m, salted))
            key = mix(hh)
            if ss.any():
                hot_ones, cold = np.flatnonzero(ss), np.flatnonzero(ss == 0)
                first = base[hot_ones] + ll[hot_ones]
                run, start, more, second = by_second(Rolling(value).grams(kind.gram), first, first + aa[hot_ones], mm[hot_ones], span)
                run = hot_ones[run]
                key = np.concatenate([key[cold], mix(key[run] ^ second)])
                ll, mm = np.concatenate([ll[cold], start - base[run]]), np.concatenate([mm[cold], more])
                hh, dd, xx, base = (np.concatenate([v[cold], v[run]]) for v in (hh, dd, xx, base))
            data = b"".join(own)
            p, q = begin[base + ll], end[base + ll + mm + w - 1]
            block = (key % np.uint64(n)).astype(np.int64)
            by = np.argsort(block, kind="stable")
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(block[by])) + 1, [len(by)]])
            for s, e in zip(cuts[:-1], cuts[1:]):
                r = by[s:e]
                lead = b"".join(np.ascontiguousarray(v[r].astype(t)).tobytes() for v, t in zip((hh, dd, xx, ll, mm, q - p), SENT))
                body = b"".join([data[u:v] for u, v in zip(p[r].tolist(), q[r].tolist())])
                out.append((int(block[by[s]]), SYMBOLS, zstandard.compress(len(r).to_bytes(8, "little") + lead + body, 1)))
        return frame(out)

    def settle_block(part: pd.DataFrame) -> pd.DataFrame:
        give_back()  # what the last group freed
        spans = unpacked(SPANS, blobs(part, SPANS))
        columns: list[list[np.ndarray]] = [[np.zeros(0, t)] for t in SENT]
        raw: list[bytes] = []
        for b in map(zstandard.decompress, blobs(part, SYMBOLS)):
            k, at = int.from_bytes(b[:8], "little"), 8
            for c, t in zip(columns, SENT):
                c.append(np.frombuffer(b, t, k, at))
                at += k * np.dtype(t).itemsize
            stops = (at + np.cumsum(columns[-1][-1], dtype=np.int64)).tolist()
            raw += [b[u:v] for u, v in zip([at, *stops], stops)]
        if raw:
            h, d, x, lo, m, _ = (np.concatenate(c) for c in columns)
            run, s, e = _resolved(resolve, kind, h, d, x, lo, m, raw)
            spans = [np.concatenate([p, q.astype(p.dtype)]) for p, q in zip(spans, joined_spans(d[run], x[run], s, e + w))]
        return frame(spans_of(*spans))

    def gather(texts: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        give_back()  # what the last group freed
        d, x, s, e = joined_spans(*unpacked(SPANS, blobs(part, SPANS)))
        spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for key, a, b in zip(zip(d.tolist(), x.tolist()), s.tolist(), e.tolist()):
            spans.setdefault(key, []).append((a, b))
        return finish(texts, [spans.get(key, []) for key in zip(_ids(texts).tolist(), texts["th"].tolist())])

    home = rows.withColumn("bucket", document_bucket(F.coalesce("doc_id", F.lit(int(NULL_ID))), F.col("th"), n))
    texts = home.withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("bucket")
    found = with_text_ids(rows, "text", "th").mapInPandas(find_runs, MESSAGE)
    wanted = found.groupBy("bucket").applyInPandas(settle_runs, MESSAGE)
    sent = texts.cogroup(wanted.groupBy("bucket")).applyInPandas(answer, MESSAGE)
    settled = sent.groupBy("bucket").applyInPandas(settle_block, MESSAGE)
    return long_ids(texts.cogroup(settled.groupBy("bucket")).applyInPandas(gather, text_ids(schema)))


def document_bucket(doc, text, n: int):
    """bucket_of as a column expression."""
    return F.pmod(F.shiftright(F.pmod(F.pmod(doc, F.lit(PRIME)) + F.pmod(text, F.lit(PRIME)), F.lit(PRIME)) * F.lit(FACTOR), 12), F.lit(n)).cast("int")
