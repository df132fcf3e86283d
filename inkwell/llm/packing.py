"""Vector best-fit packing of tokenised documents into training sequences.

Only lengths move between executors: texts are tokenised where they are read, pieces (a few numbers each) are
dealt at random to groups of bounded size, and each group is packed on its own. A group wastes less than one
sequence beyond what best-fit itself leaves, so thousands of pieces a group cost nothing visible.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, cut, held, long_ids, text_ids, with_text_ids

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


#: Lower-case words that the tokenizer's normaliser leaves as they are and that it never splits.
_plain = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+")
_marks = b".,;:!?#*$%&"


class WordIds:
    """Token ids (little-endian uint32) of words between ASCII white space.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its words in a row. It
    also lower-cases, and separates letters from the marks after them. What a batch's words lack is worked out in one
    call. Words are held in two generations: when the younger weighs more than `room`
    bytes the older goes, and with it only words that no text had since."""

    def __init__(self, path: str, room: int = 120_000_000) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core already
        self.tokenizer, self.room = Tokenizer.from_file(path), room
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.last[i] = token.endswith("</w>")
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.weight = 0

    def _encoded(self, parts: list[str]) -> list[bytes]:
        """Ids of each part: those of plain letters, which end with the one word end they have, many in a text."""
        out = [b""] * len(parts)
        low = [p.lower() for p in parts]
        plain = [i for i, p in enumerate(low) if _plain.fullmatch(p)]
        texts = [" ".join(low[i] for i in plain[k : k + 64]) for k in range(0, len(plain), 64)]
        if texts:
            ids = np.concatenate([np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            at = np.concatenate([[0], np.flatnonzero(self.last[ids]) + 1]) * 4
            raw = ids.tobytes()
            for i, a, b in zip(plain, at[:-1].tolist(), at[1:].tolist()):
                out[i] = raw[a:b]
        others = sorted(set(range(len(parts))) - set(plain))
        if others:
            for i, e in zip(others, self.tokenizer.encode_batch_fast([parts[i] for i in others], add_special_tokens=False)):
                out[i] = struct.pack(f"<{len(e.ids)}I", *e.ids)
        return out

    def _learn(self, words: set[bytes]) -> None:
        new = []
        for word in words:
            if (held := self.old.get(word)) is None:
                new.append(word)
            else:
                self.young[word] = held
        cores, tails = [], []
        for word in new:
            core = word.rstrip(_marks)
            # marks are parts of their own after a letter, ASCII or Latin-1
            letter = core[-1:].isalpha() or (core[-2:-1] == b"\xc3" and core[-1:] != b"\x97" and core[-1:] != b"\xb7")
            core, tail = (core, word[len(core) :]) if letter else (word, b"")
            # the parts of a special token must not meet it in another case
            cores.append(core if b"<|" in core else core.lower())
            tails.append(tail)
        parts = [p for p in {*cores, *tails} if p not in self.young]
        self.young.update(zip(parts, self._encoded([p.decode(errors="replace") for p in parts])))
        found = self.young.__getitem__
        self.young.update(zip(new, map(bytes.__add__, map(found, cores), map(found, tails))))
        self.weight += sum(map(len, parts)) + sum(map(len, words)) + sum(map(len, map(found, words))) + 150 * (len(parts) + len(words))

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """Each text's ids."""
        if self.weight > self.room:
            self.old, self.young, self.weight = self.young, {}, 0
        split = [t.split() for t in texts]
        words = list(chain.from_iterable(split))
        found = list(map(self.young.get, words))
        if lacking := [k for k, ids in enumerate(found) if ids is None]:
            self._learn({words[k] for k in lacking})
            for k in lacking:
                found[k] = self.young[words[k]]
        at = 0
        for own in split:
            yield b"".join(found[at : at + len(own)])
            at += len(own)


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece of a document: its ids, then end_id, cut every `length` ids.

    A null text is empty and gives the piece [end_id]. Repeated rows give repeated pieces; a null doc_id stays; an
    empty table gives an empty result, and extra columns are not read."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory, tail = held(f"ids {tokenizer_path}", lambda: WordIds(tokenizer_path)), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            raw = [t.encode() if isinstance(t, str) else b"" for t in batch["text"]]
            for at, to in chunks(raw, 1_000_000):
                part = batch.iloc[at:to]
                rows = []
                for doc, ids in zip(part["doc_id"], memory.ids(raw[at:to])):
                    ids += tail
                    for k, start in enumerate(range(0, len(ids) // 4, length)):
                        own = ids[4 * start : 4 * (start + length)]
                        rows.append((doc, k, start, len(own) // 4, zlib.crc32(own)))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return long_ids(with_text_ids(docs, "text").mapInPandas(pieces, text_ids(PIECES)))


def best_fit(
    lengths: np.ndarray, tokens: int, documents: int, attention: float, rule: str = "norm", weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, longest first. A bin has three residual capacities: tokens, documents and
    attention cost (the sum of squared lengths). Of the bins that can take a piece under all three, the one with
    the smallest weighted norm of what is left then ("norm") or the largest weighted dot product of demand and
    residual ("dot") is taken; a new one is opened only if none can. Ties go to the older bin."""
    order = np.argsort(-lengths, kind="stable")
    smallest = int(lengths.min()) if len(lengths) else 1
    capacity = np.array([tokens, documents, attention], float)
    left = np.zeros((64, 3))
    open_bins = np.zeros(64, np.int64)
    used = bins = 0
    filled: list[int] = []
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    w = np.array(weights) / capacity**2
    for at, i in enumerate(order):
        n = int(lengths[i])
        need = np.array([n, 1.0, float(n) * n])
        if at % 64 == 0 and used:  # bins that can take nothing more are closed
            live = (left[:used] >= [smallest, 1, smallest * smallest]).all(axis=1)
            kept = int(live.sum())
            left[:kept], open_bins[:kept] = left[:used][live], open_bins[:used][live]
            used = kept
        rest = left[:used] - need
        fits = np.flatnonzero((rest >= 0).all(axis=1))
        if len(fits):
            score = (rest[fits] ** 2) @ w if rule == "norm" else -(left[fits] * need) @ w
            k = int(fits[np.argmin(score)])
        else:
            if used == len(left):
                left, open_bins = np.concatenate([left, np.zeros_like(left)]), np.concatenate([open_bins, np.zeros_like(open_bins)])
            left[used], open_bins[used] = capacity, bins
            filled.append(0)
            k, bins, used = used, bins + 1, used + 1
        left[k] -= need
        bin_of[i], offset[i] = open_bins[k], filled[open_bins[k]]
        filled[open_bins[k]] += n
    return bin_of, offset


def pack(
    pieces: DataFrame, tokens: int = 2048, documents: int = 2048, attention: float | None = None, group_pieces: int = 20_000, rule: str = "norm"
) -> DataFrame:
    """pieces (with a `length` of at most `tokens`) with sequence_id and offset; every input column is kept.

    Full pieces are sequences of their own. The others are dealt to groups of about group_pieces by a seeded hash
    of the row's place in the written table, so that no repeated document or length can fill one group. An empty
    table gives an empty result. Columns named sequence_id or offset in the input are replaced; any other name may
    occur, `_row` and `_group` included.

    The defaults of `documents` and `attention` can't bind (a piece has a token at least, and a sum of squares is at
    most the square of the sum): packing is by tokens alone then, and the norm only shapes which bin is taken."""
    attention = float(tokens) ** 2 if attention is None else attention
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    given = [f"c{i}" for i in range(len(names))]
    size = given[names.index("length")]
    pieces = cut(pieces.select(*(F.col(f"`{c}`").alias(g) for c, g in zip(names, given)), F.monotonically_increasing_id().alias("row")))
    full = F.col(size) >= tokens
    groups = max(1, round(pieces.filter(~full).count() / group_pieces))
    rows = pieces.withColumn("part", F.pmod(F.xxhash64("row", F.lit(17)), F.lit(groups)))
    # beside a null, pandas holds whole numbers as doubles: longs, which may not fit, go as text
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema if f.name != "row"}
    long, whole = [c for c, k in kinds.items() if k == "bigint" and c != size], [c for c, k in kinds.items() if k in ("int", "smallint", "tinyint")]

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("row", ignore_index=True)
        b, o = best_fit(part[size].to_numpy(), tokens, documents, attention, rule)
        part["sequence_id"], part["offset"] = (part["part"].to_numpy() << 40) + b, o
        for c in whole:
            part[c] = part[c].astype("Int64")
        return part.drop(columns=["part", "row"])

    schema = ", ".join(f"{c} {'string' if c in long else k}" for c, k in kinds.items()) + ", sequence_id bigint, offset bigint"
    alone = rows.filter(full).select(*given, (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    dealt = rows.filter(~full).withColumns({c: F.col(c).cast("string") for c in long}).groupBy("part").applyInPandas(packed, schema)
    dealt = dealt.withColumns({c: F.col(c).cast("bigint") for c in long})
    return dealt.unionByName(alone).toDF(*names, "sequence_id", "offset")
