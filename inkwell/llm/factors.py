"""Removal of repeated word sequences by relative Lempel-Ziv parsing."""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .windows import WORDS, Kind, Runs, repeated_spans

SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def resolve_by_factors(runs: Runs, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of a block's runs that also start earlier, by relative Lempel-Ziv factors.

    Runs of one document that touch or overlap are one segment. In the order of the corpus each segment is parsed
    greedily against the reference, which is all segments before it and what has been parsed of its own, indexed by
    the `kind.window` words at each place that no factor covers. A factor goes on as long as its words equal the
    reference's; at its end the windows that reach beyond it are looked up one by one, since they may stand elsewhere
    in the reference, and the next factor begins with the first that does."""
    w = kind.window
    turn = np.lexsort((runs.start, runs.place))
    code: dict[bytes, int] = {}
    reference = array("i")
    index: dict[bytes, int] = {}
    found: list[tuple[int, int, int]] = []
    place, start, windows = (v[turn].tolist() for v in (runs.place, runs.start, runs.windows))
    k, turn = 0, turn.tolist()
    while k < len(turn):
        head, base = k, len(reference)
        end = start[k]  # the segment's words reach up to here
        while k < len(turn) and place[k] == place[head] and start[k] <= max(end - w + 1, start[head]):
            words = runs.raw[turn[k]].split()
            reference.extend([code.setdefault(x, len(code)) for x in words[max(0, end - start[k]) :]])
            end = max(end, start[k] + windows[k] + w - 1)
            k += 1
        at, stop, own, shift = base, len(reference) - w, turn[head], start[head] - base
        raw = memoryview(reference).cast("B")
        while at <= stop:
            key = raw[4 * at : 4 * (at + w)].tobytes()
            there = index.setdefault(key, at)
            if there == at:
                at += 1
                continue
            length = w
            while at + length < len(reference) and reference[there + length] == reference[at + length]:
                length += 1
            found.append((own, at + shift, at + length - w + shift))
            at += length - w + 1
        raw.release()
        reference.append(-1 - len(found))  # no factor goes on beyond a segment
    out = np.array(found, np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


def remove_repeated_words(docs: DataFrame, **options: int) -> DataFrame:
    """Per document: n_words, n_removed and the SHA-256 of the words left, joined by one space, once every word is
    removed that a 20-word window covers which also starts earlier.

    A null text has no words; texts under 20 words lose nothing. Equal rows, rows of one id with different texts,
    null ids, empty tables and extra columns are treated as by suffixes.remove_repeats."""

    def finish(rows: pd.DataFrame, spans: list[list[tuple[int, int]]]) -> pd.DataFrame:
        out = []
        for doc, text, own in zip(rows["doc_id"], rows["text"], spans):
            words = text.encode().split() if isinstance(text, str) else []
            kept, at = [], 0
            for s, e in own:
                kept += words[at:s]
                at = e
            kept += words[at:]
            out.append((doc, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        return pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return repeated_spans(docs.select("doc_id", "text"), WORDS, resolve_by_factors, finish, SCHEMA, **options)
