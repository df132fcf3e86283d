"""Language identification by error-correcting output codes.

Each language has a codeword; one binary classifier per bit, on hashed character n-grams, predicts it. Decoding
adds each bit's logistic loss against every codeword and takes the nearest; a small margin marks the text ambiguous.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import crc_fold, let_go

SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double, ambiguous boolean"
WIDTH = 1 << 13


def codewords(n: int, bits: int, seed: int = 5) -> np.ndarray:
    """n rows of +1 / -1: of several seeded draws the one with the largest least distance, no constant bit."""
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(200 if n <= 200 else 3):
        c = rng.choice([-1, 1], (n, bits))
        d = 0
        if n > 1:
            flat = np.abs(c.sum(axis=0)) == n
            c[0, flat] *= -1
            x = c.astype(np.float32)
            # the distance of two words is half of bits less their product
            near = max(int((x[i + 1 :] @ x[i]).max()) for i in range(n - 1)) if n > 4096 else int((x @ x.T - 2 * bits * np.eye(n, dtype=np.float32)).max())
            d = (bits - near) // 2
        if d > far:
            best, far = c, d
    return best


def features(texts: list[str]) -> np.ndarray:
    """Relative frequencies of hashed 1-, 2- and 3-grams of letters; anything else between letters is one blank."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    for row, text in enumerate(texts):
        for at in range(0, len(text), 1 << 20):  # long texts in overlapping parts, summed
            out[row] += _grams(text[max(0, at - 2) : at + (1 << 20)])
    out = np.sqrt(out)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(norm, 1e-9)


_letter = np.zeros(0x110000, np.uint32)


def _fold() -> np.ndarray:
    """Code point to lower-case letter, or to a blank."""
    if not _letter.any():
        _letter[:] = 32
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                _letter[c] = ord(low[0])
    return _letter


def _grams(text: str) -> np.ndarray:
    x = _fold()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if len(x) > 1:
        x = x[np.concatenate([[True], (x[1:] != 32) | (x[:-1] != 32)])]
    total = np.zeros(WIDTH, np.float32)
    bits = np.uint32(32 - 13)
    a = x * np.uint32(0x9E3779B1)
    code = [a]
    if len(x) > 1:
        code.append((a[:-1] ^ (x[1:] << np.uint32(11))) * np.uint32(0x85EBCA6B))
    if len(x) > 2:
        code.append((code[1][:-1] ^ (x[2:] << np.uint32(9))) * np.uint32(0xC2B2AE35))
    for c in code:
        total += np.bincount((c ^ (c >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> bits, minlength=WIDTH)[:WIDTH]
    return total


class LanguageModel:
    """Codewords and one linear classifier per bit."""

    def __init__(self, languages: list[str], codes: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> None:
        self.languages, self.codes, self.weights, self.bias = languages, codes, weights, bias

    @classmethod
    def fit(cls, x: np.ndarray, langs: list[str], bits: int | None = None, rounds: int = 60, l2: float = 1e-5) -> LanguageModel:
        languages = sorted(set(langs))
        # more languages need longer words to stay apart
        bits = bits or max(31, 2 * math.ceil(3 * math.log2(len(languages) + 1)) + 1)
        codes = codewords(len(languages), bits)
        place = {k: i for i, k in enumerate(languages)}
        y = np.array([place[k] for k in langs])
        share = np.bincount(y, minlength=len(languages))[y]
        s = (len(y) / len(languages) / share)[:, None] / len(y)  # each language counts the same
        target = codes[y].astype(np.float32)
        w, b = np.zeros((WIDTH, bits), np.float32), np.zeros(bits, np.float32)
        mw, vw = np.zeros_like(w), np.zeros_like(w)
        mb, vb = np.zeros_like(b), np.zeros_like(b)
        for t in range(1, rounds + 1):  # Adam on the logistic loss
            g = (-target / (1 + np.exp(np.clip(target * (x @ w + b), -30, 30))) * s).astype(np.float32)
            for p, m, v, d in ((w, mw, vw, x.T @ g + l2 * w), (b, mb, vb, g.sum(axis=0))):
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                p -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return cls(languages, codes, w, b)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index, score, margin): losses log(1 + exp(-bit * output)) summed by codeword; the score is the nearest
        codeword's share of exp(-loss), the margin how much nearer it is than the second, per bit."""
        z = np.clip(x @ self.weights + self.bias, -8, 8)
        loss = np.logaddexp(0, -z[:, None, :] * self.codes[None, :, :]).sum(axis=2)
        share = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        two = np.sort(loss, axis=1)
        margin = (two[:, 1] - two[:, 0]) / len(self.bias) if loss.shape[1] > 1 else np.ones(len(x))
        return best, share[np.arange(len(x)), best], margin


def fit_language(docs: DataFrame, sample: int = 3000) -> LanguageModel | None:
    """A model from about `sample` rows (a documented bound, spread evenly over all languages, one row of each at
    least, drawn by a seeded hash of id and text) with crc32(doc_id) mod 5 != 0, a language and a text with letters;
    None if there is none."""
    rows = docs.filter((crc_fold() != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").count().collect()  # a row for each language
    if not counts:
        return None
    each = max(1, sample // len(counts))
    # the draw takes more than it needs, so that texts without letters may fail; equal rows draw alike and count once
    rates = docs.sparkSession.createDataFrame([(r["lang"], (1.5 * each + 8) / r["count"]) for r in counts], "lang string, rate double")
    draw = F.pmod(F.xxhash64("doc_id", F.xxhash64("text"), F.lit(3)), F.lit(1 << 30)) / F.lit(1 << 30)
    drawn = rows.join(F.broadcast(rates), "lang").withColumn("draw", draw).filter("draw < rate").filter(F.col("text").rlike(r"\p{L}"))
    drawn = drawn.groupBy("lang", "draw").agg(F.min("text").alias("text"))
    drawn = drawn.withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy("draw"))).filter(F.col("turn") <= each).select("lang", "draw", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, draws, texts = (batch.column(i).to_pylist() for i in range(3))
            out = []
            for k in range(len(texts)):
                x = features([texts[k]])[0]
                at = np.flatnonzero(x)
                out.append((langs[k], draws[k], at.astype("<u2").tobytes(), x[at].astype("<f4").tobytes()))
            names = ["lang", "draw", "at", "x"]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=pa.schema(list(zip(names, (pa.string(), pa.float64(), pa.binary(), pa.binary())))))

    chosen = sorted(drawn.mapInArrow(vectors, "lang string, draw double, at binary, x binary").collect(), key=lambda r: (r["lang"], r["draw"], r["at"]))
    if not chosen:
        return None
    x = np.zeros((len(chosen), WIDTH), np.float32)
    for k, r in enumerate(chosen):
        x[k, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["x"], "<f4")
    return LanguageModel.fit(x, [r["lang"] for r in chosen])


def identify(docs: DataFrame, model: LanguageModel | None, min_margin: float = 0.02, keep_rows: bool = False) -> DataFrame:
    """One row per document: held_out, lang_pred, score in 0..1, ambiguous; with keep_rows also the row as `_row`.

    A text that is null or has no letter is `und` with score 0, ambiguous; so is every text if there is no model.
    Only the text is read for a prediction; whole texts count, in overlapping parts summed up. Repeated rows and
    null ids get a row each, an empty table gives an empty result, and other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH * bits floats, whatever the corpus

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        m = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                given = batch.column(2)
                texts = [t or "" for t in (given.field("text") if keep_rows else given).to_pylist()]
                lettered = np.array([any(map(str.isalpha, t)) for t in texts], bool)
                pred, score, unsure = np.full(len(texts), "und", object), np.zeros(len(texts)), np.ones(len(texts), bool)
                if m is not None and lettered.any():
                    best, share, margin = m.decode(features([t for t, k in zip(texts, lettered) if k]))
                    pred[lettered], score[lettered], unsure[lettered] = np.array(m.languages, object)[best], share, margin < min_margin
                columns = [batch.column(0), batch.column(1), pa.array(pred, pa.string()), pa.array(score), pa.array(unsure), *[given] * keep_rows]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score", "ambiguous", *["_row"] * keep_rows])

    given = docs.select(F.col("doc_id").cast("bigint"), (crc_fold() == 0).alias("held_out"), F.struct("*").alias("_row") if keep_rows else "text")
    schema = StructType.fromDDL(SCHEMA)
    if keep_rows:
        schema = schema.add(given.schema["_row"])
    return given.mapInArrow(judged, schema)
