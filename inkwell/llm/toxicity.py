"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Terms are lower-cased words and their first five bytes. The index holds every term of a bounded sample of
labelled rows. Everything else covers all data: document frequencies of those terms count all documents, and every
document is scored by its whole text. A term's weight grows with how surely the examples of the two labels differ in
it (`_telling`); none is dropped, so that an equal text is always found with cosine 1.

The index holds the examples in blocks; for each of the most frequent terms and each block it has the largest weight.
A query sums up its rarer terms' postings, visits the blocks of the greatest bound that these and the maxima give, and
then all others that can reach its k-th neighbour, so the neighbours are those of a full scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_VALUE, Rolling, chunks, crc_fold, cut, long_ids, mix, text_ids, with_text_ids

PREFIXES = (5,)
SCHEMA = (
    "doc_id bigint, held_out boolean, score double, predicted int, n_terms int, "
    "evidence array<struct<doc_id:bigint,toxic:int,cosine:double>>"
)

#: Bytes that belong to words: ASCII letters and everything beyond ASCII.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of all terms of all texts, repeats included. A prefix is marked by its length, so that the
    prefix `idio` and a word `idio` are different terms; a word as long as a prefix has both."""
    raw = [t.lower().encode(errors="replace") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    ends = np.cumsum(sizes + 1)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], _LETTER[data], [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    text = np.searchsorted(ends, start, side="right")
    roll = Rolling(BYTE_VALUE[data])
    values, owners = [roll.slices(start, end)], [text]
    for k in PREFIXES:
        long = end - start >= k
        values.append(mix(roll.slices(start[long], start[long] + k) ^ np.uint64(k)))
        owners.append(text[long])
    return np.concatenate(values), np.concatenate(owners)


def counted(value: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, text, count) of the distinct pairs, by text then value."""
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    first = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (text[1:] != text[:-1])])) if len(value) else np.zeros(0, np.int64)
    return value[first], text[first], np.diff(np.concatenate([first, [len(value)]]))


class Vocabulary:
    """Sorted term hashes, and an open-addressed table of them that looks up many at once."""

    def __init__(self, terms: np.ndarray) -> None:
        self.terms = np.unique(terms.astype(np.uint64))
        self.mask = (1 << max(16, (4 * len(self.terms)).bit_length())) - 1
        self.table = np.full(self.mask + 1, -1, np.int32)
        left, slot = np.arange(len(self.terms)), self._slot(self.terms)
        while len(left):
            free = self.table[slot] < 0
            self.table[slot[free]] = left[free]
            lost = self.table[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & self.mask

    def __reduce__(self) -> tuple:
        return Vocabulary, (self.terms,)  # the table is built where it is used

    def _slot(self, value: np.ndarray) -> np.ndarray:
        return (value & np.uint64(self.mask)).astype(np.int64)

    def find(self, value: np.ndarray) -> np.ndarray:
        """Each hash's term index, -1 if it is none."""
        out = np.full(len(value), -1, np.int64)
        left, slot = np.arange(len(value)), self._slot(value)
        while len(left):
            at = self.table[slot]
            some = at >= 0
            left, slot, at = left[some], slot[some], at[some]
            same = self.terms[at] == value[left]
            out[left[same]] = at[same]
            left, slot = left[~same], (slot[~same] + 1) & self.mask
        return out

    def vectors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term index, text, count) of the vocabulary's terms in the texts, by text then term."""
        value, text = terms_of(texts)
        term = self.find(value)
        n = max(1, len(self.terms))
        key = np.sort((text * n + term)[term >= 0])
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        return key[first] % n, key[first] // n, np.diff(np.concatenate([first, [len(key)]]))


class BlockMaxIndex:
    """Unit vectors of examples. The terms in most examples (`dense` of them) stand in blocks of examples, as a matrix
    with each term's maximum in each block; the others as postings term -> (example, weight)."""

    def __init__(self, term: np.ndarray, example: np.ndarray, weight: np.ndarray, n_terms: int, n_examples: int, block: int = 256, dense: int = 1024) -> None:
        self.block, self.n_terms, self.n_examples = block, n_terms, n_examples
        self.n_blocks = -(-n_examples // block)
        often = np.argsort(-np.bincount(term, minlength=n_terms), kind="stable")[:dense]
        self.column = np.full(n_terms, -1, np.int32)
        self.column[often] = np.arange(len(often))
        common = self.column[term] >= 0
        self.matrix = np.zeros((self.n_blocks, len(often), block))
        self.matrix[example[common] // block, self.column[term[common]], example[common] % block] = weight[common]
        self.most = self.matrix.max(axis=2).T
        term, example, weight = term[~common], example[~common], weight[~common]
        order = np.argsort(term, kind="stable").astype(np.int32)
        self.example, self.weight = example[order], weight[order]
        self.at = np.searchsorted(term[order], np.arange(n_terms + 1))

    def nearest(self, term: np.ndarray, query: np.ndarray, weight: np.ndarray, n_queries: int, k: int, at_once: int = 128) -> tuple[np.ndarray, np.ndarray]:
        """(example, cosine), k a query in descending order, equal ones by example; -1 and 0 where fewer share a
        term. The queries' vectors must come by query. Exact: a block left out of a search is bounded by less than
        the k-th cosine; those with an equal bound are visited, for their ties."""
        found = np.full((n_queries, k), -1, np.int64)
        cosine = np.zeros((n_queries, k))
        if not self.n_blocks or not len(term):
            return found, cosine
        begin = np.searchsorted(query, np.arange(n_queries + 1))
        for q in range(0, n_queries, at_once):
            n = min(at_once, n_queries - q)
            own = slice(begin[q], begin[q + n])
            found[q : q + n], cosine[q : q + n] = self._nearest(term[own], query[own] - q, weight[own], n, k)
        return found, cosine

    def _nearest(self, term: np.ndarray, query: np.ndarray, weight: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        width = self.n_blocks * self.block
        column = self.column[term]
        common = column >= 0
        vector = np.zeros((n, len(self.most)))
        vector[query[common], column[common]] = weight[common]
        # what the other terms add is summed up from all of their postings, query by query to stay in the cache
        term, query, weight = term[~common], query[~common], weight[~common]
        first, size = self.at[term], self.at[term + 1] - self.at[term]
        begin, flat = np.searchsorted(query, np.arange(n + 1)), np.zeros((n, width))
        for i in range(n):
            own = slice(begin[i], begin[i + 1])
            many = size[own]
            reach = np.cumsum(many)
            if len(reach) and reach[-1]:
                post = np.repeat((first[own] - (reach - many)).astype(np.int32), many)
                post += np.arange(len(post), dtype=np.int32)
                flat[i] = np.bincount(self.example[post], np.repeat(weight[own], many) * self.weight[post], minlength=width)
        score = flat.reshape(n, self.n_blocks, self.block)
        bound = vector @ self.most + score.max(axis=2) + 1e-9  # for the rounding of sums in another order
        # the most promising blocks first: they give the k-th cosine that the others must reach
        lead = min(self.n_blocks, 2 + k // self.block + self.n_blocks // 16)
        to_visit = np.zeros(bound.shape, bool)
        np.put_along_axis(to_visit, np.argpartition(-bound, lead - 1, axis=1)[:, :lead], True, axis=1)
        done = np.zeros(bound.shape, bool)
        for _ in range(2):
            for b in np.flatnonzero(to_visit.any(axis=0)):
                rows = np.flatnonzero(to_visit[:, b])
                score[rows, b] += (vector if len(rows) == n else vector[rows]) @ self.matrix[b]
            done |= to_visit
            seen = np.where(done[:, :, None], score, 0.0).reshape(n, width)
            least = -np.partition(-seen, k - 1, axis=1)[:, k - 1] if k <= width else np.zeros(n)
            to_visit = ~done & (bound >= least[:, None] - 1e-9)
            if not to_visit.any():
                break
        row, example = np.nonzero((seen >= least[:, None] - 1e-9) & (seen > 0))
        value = np.round(seen[row, example], 12)
        order = np.lexsort((example, -value, row))
        row, example, value = row[order], example[order], value[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        best = rank < k
        found, cosine = np.full((n, k), -1, np.int64), np.zeros((n, k))
        found[row[best], rank[best]], cosine[row[best], rank[best]] = example[best], value[best]
        return found, cosine


class ToxicityModel:
    """Terms, document frequencies and labelled examples; everything in it is bounded by the examples' texts."""

    def __init__(self, vocabulary: Vocabulary, df: np.ndarray, n_docs: int, examples: list[tuple], weights: tuple[float, float], k: int = 15) -> None:
        """examples: (doc_id, toxic, term indexes, counts); weights: what an example of label 0 and of 1 stands for."""
        self.k, self.vocabulary = k, vocabulary
        examples = sorted(examples, key=lambda e: (e[0], e[1], e[2].tobytes(), e[3].tobytes()))
        self.ids = np.array([e[0] for e in examples], np.int64)
        self.toxic = np.array([e[1] for e in examples], np.int64)
        self.stands = np.where(self.toxic == 1, weights[1], weights[0])
        self.term = np.concatenate([e[2] for e in examples]).astype(np.int32) if examples else np.zeros(0, np.int32)
        self.count = np.concatenate([e[3] for e in examples]).astype(np.uint32) if examples else np.zeros(0, np.uint32)
        self.sizes = np.array([len(e[2]) for e in examples], np.int64)
        owner = np.repeat(np.arange(len(examples), dtype=np.int32), self.sizes)
        self.idf = (np.log((1 + n_docs) / (1 + df)) + 1) * self._telling(self.term, owner)
        blank = self.sizes == 0
        both = self.stands.sum() or 1.0
        self.prior = float((self.stands * self.toxic).sum() / both)
        # texts without a term of any example: the share of toxic ones among the examples without any
        own = self.stands[blank]
        self.blank = float(((own * self.toxic[blank]).sum() + self.prior) / (own.sum() + 1))
        self.slope, self.shift = 1.0, 0.0

    def build(self) -> tuple[BlockMaxIndex, np.ndarray]:
        owner = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.sizes)
        vectors = self.term, owner, self.unit(self.term, owner, self.count, len(self.ids))
        return BlockMaxIndex(*vectors, len(self.vocabulary.terms), len(self.ids)), vectors[2]

    @property
    def index(self) -> BlockMaxIndex:
        """Built where it is first used: it is several times larger than what it is built from."""
        if not hasattr(self, "_built"):
            self._built, self._weight = self.build()
        return self._built

    def _telling(self, term: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """0.02 to 1.02 a term, by the squared deviate of the two labels' shares of examples with it."""
        n1, n0 = max(1, int(self.toxic.sum())), max(1, int((1 - self.toxic).sum()))
        both = np.bincount(term, minlength=len(self.vocabulary.terms))
        one = np.bincount(term, self.toxic[owner], minlength=len(both)) if len(term) else both
        p = both / (n1 + n0)
        z2 = (one / n1 - (both - one) / n0) ** 2 / (np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
        return 0.02 + z2 / (z2 + 36)

    def unit(self, term: np.ndarray, owner: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        """(1 + ln tf) * idf, scaled to length 1."""
        w = (1 + np.log(np.maximum(count, 1))) * self.idf[term]
        norm = np.sqrt(np.bincount(owner, w * w, minlength=n))
        return w / np.maximum(norm, 1e-300)[owner] if len(w) else w

    def votes(self, found: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        """Share of toxic votes: each neighbour's is what it stands for by cosine ** 2 / (0.05 + distance), with the
        prior as half a vote; without neighbours the score of texts without a term."""
        if not len(self.ids):
            return np.full(len(found), self.blank)
        w = np.where(found >= 0, self.stands[found] * cosine**2 / (0.05 + 1 - np.minimum(cosine, 1)), 0.0)
        share = ((w * (self.toxic[found] == 1)).sum(axis=1) + 0.5 * self.prior) / (w.sum(axis=1) + 0.5)
        return np.where((found >= 0).any(axis=1), share, self.blank)

    def left_out(self, own: np.ndarray) -> np.ndarray:
        """Logits of the votes for these examples (a range of them), each without itself."""
        index, reach = self.index, np.concatenate([[0], np.cumsum(self.sizes)])
        at = slice(reach[own[0]], reach[own[-1] + 1])
        query = np.repeat(np.arange(len(own)), self.sizes[own])
        found, cosine = index.nearest(self.term[at], query, self._weight[at], len(own), self.k + 1)
        found = np.where(found == own[:, None], -1, found)
        return self.logit(self.votes(found, np.where(found >= 0, cosine, 0)))

    def calibrate(self, x: np.ndarray) -> None:
        """A logistic curve through the leave-one-out votes of the examples, with smoothed targets."""
        n = len(self.ids)
        if not n or self.toxic.min() == self.toxic.max():
            return
        s = self.stands / self.stands.sum() * n
        ones = (s * self.toxic).sum()
        target = np.where(self.toxic == 1, (ones + 1) / (ones + 2), 1 / (n - ones + 2))
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps on two numbers
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            g = np.array([(s * (p - target) * x).sum() + 1e-3 * (a - 1), (s * (p - target)).sum()])
            v = s * np.maximum(p * (1 - p), 1e-6)
            h = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-6]])
            step = np.linalg.solve(h, g)
            step *= min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
            a, b = a - step[0], b - step[1]
        if a > 0:
            self.slope, self.shift = float(a), float(b)

    @staticmethod
    def logit(p: np.ndarray) -> np.ndarray:
        p = np.clip(p, 1e-6, 1 - 1e-6)
        return np.log(p / (1 - p))

    def logits(self, term: np.ndarray, owner: np.ndarray, count: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(logit of the votes, example, cosine) of n texts with these terms."""
        found, cosine = self.index.nearest(term, owner, self.unit(term, owner, count, n), n, self.k)
        return self.logit(self.votes(found, cosine)), found, cosine


def _drawn(labels: DataFrame, each: int) -> tuple[DataFrame, dict[int, int], dict[int, int]]:
    """(doc_id, toxic) of the sample, at most `each` rows a label by a seeded hash of the id, and the rows that each
    label has in all, and in the sample."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (crc_fold() != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("draw", F.xxhash64("doc_id", F.lit(11)))
    total = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    parts = [known.filter(F.col("toxic") == y).orderBy("draw", "doc_id").limit(each) for y in (0, 1)]
    return cut(parts[0].unionByName(parts[1]).select("doc_id", "toxic")), total, {y: min(each, total.get(y, 0)) for y in (0, 1)}


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """doc_id, toxic and the text's distinct terms with their counts."""
    for batch in batches:
        texts = [t if isinstance(t, str) else "" for t in batch["text"]]
        for i, j in chunks(texts, 2_000_000):
            value, text, count = counted(*terms_of(texts[i:j]))
            at = np.searchsorted(text, np.arange(j - i + 1))
            value, count = value.astype("<u8"), count.astype("<u4")
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].iloc[i:j], "toxic": batch["toxic"].iloc[i:j],
                    "terms": [value[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], "counts": [count[a:b].tobytes() for a, b in zip(at[:-1], at[1:])],
                }
            )


def toxicity(docs: DataFrame, labels: DataFrame, examples: int = 2000, k: int = 15) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_terms, evidence (the nearest examples).

    Fitted on at most `examples` labelled rows of each label (documented bound; seeded draw among ids with
    crc32 mod 5 != 0; several labels of one id count as the largest, of several texts the one of the least hash is
    taken). Only the text is read for a score. A null or
    empty text, or one without a term of any example, gets the score of examples without any, and no evidence;
    without any labelled row every score is 0. Repeated rows are scored alike; a null doc_id stays null. An empty
    table gives an empty result; other columns are not read."""
    drawn, total, have = _drawn(labels, examples)
    # one text a drawn id, so 2 * examples rows at most, however often an id is repeated
    sample = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "toxic")
    sample = sample.agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x")).select("doc_id", "x.text", "toxic")
    chosen = sample.mapInPandas(_hashed, "doc_id bigint, toxic int, terms binary, counts binary").collect()
    words = Vocabulary(np.frombuffer(b"".join(r["terms"] for r in chosen), "<u8"))
    held = [(r["doc_id"], r["toxic"], words.find(np.frombuffer(r["terms"], "<u8")).astype(np.int32), np.frombuffer(r["counts"], "<u4")) for r in chosen]
    del chosen
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = shared.value
        total, n = np.zeros(len(v.terms), np.int64), 0
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for i, j in chunks(texts, 2_000_000):
                total += np.bincount(v.vectors(texts[i:j])[0], minlength=len(total))
            n += len(batch)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"term": np.concatenate([[-1], some]), "df": np.concatenate([[n], total[some]])})

    met = docs.select("text").mapInPandas(frequencies, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    term, count = met["term"].to_numpy(), met["df"].to_numpy()
    df = np.zeros(len(words.terms))
    df[term[term >= 0]] = count[term >= 0]
    n_docs = int(count[term < 0].sum())
    del met, term, count
    stand = tuple(total.get(y, 0) / max(1, have[y]) for y in (0, 1))
    model = ToxicityModel(words, df, n_docs, held, stand, k)
    del held
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def left_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["id"].to_numpy()
            yield pd.DataFrame({"id": own, "x": sent.value.left_out(own) if len(own) else np.zeros(0)})

    parts = max(1, len(model.ids) // 512)
    rows = docs.sparkSession.range(0, len(model.ids), 1, parts).mapInPandas(left_out, "id bigint, x double").collect() if len(model.ids) else []
    model.calibrate(np.array([x for _, x in sorted(map(tuple, rows))]))
    slope, shift = model.slope, model.shift
    del model

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for i, j in chunks(texts, 1_000_000):
                part, own = batch.iloc[i:j], m.vocabulary.vectors(texts[i:j])
                x, found, cosine = m.logits(*own, j - i)
                score = 1 / (1 + np.exp(-(slope * x + shift)))
                if not len(m.ids):
                    score = np.zeros(len(part))
                evidence = [
                    [{"doc_id": int(m.ids[e]), "toxic": int(m.toxic[e]), "cosine": float(c)} for e, c in zip(es[:5], cs[:5]) if e >= 0]
                    for es, cs in zip(found, cosine)
                ]
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"], "held_out": part["held_out"], "score": score, "predicted": (score >= 0.5).astype(np.int32),
                        "n_terms": np.bincount(own[1], minlength=j - i).astype(np.int32), "evidence": evidence,
                    }
                )

    return long_ids(with_text_ids(docs, "text", (crc_fold() == 0).alias("held_out")).mapInPandas(judge, text_ids(SCHEMA)))
