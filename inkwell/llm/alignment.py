"""Alignment of two tokenizers over the bytes of a text, and how usual each pair of overlapping tokens is.

A text's bytes have two owners each, a token of A and one of B. Where the pair of owners changes, a new overlap (link)
begins; where both change at once, the text is cut into groups. Neither tokenizer joins anything across a place where
white space follows another character, so texts are looked up segment by segment (white space and what follows it) and
owner arrays are only laid out for segments that a worker hasn't met.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held, table

MARK = "▁"  # stands for a space in B's pieces
#: A segment begins with a space or newline that follows another character (or the text's start).
_SEGMENT = re.compile(r"[ \n][^ \n]*(?:(?<=\s)[ \n]+[^ \n]*)*")
_TEXT_BYTES = 65536  # of new segments that are encoded in one call


def byte_level() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the other bytes in
    ascending order for the code points from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def owner_array(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each byte of a text, the index of the token that it belongs to."""
    return np.repeat(np.arange(len(ids)), sizes[ids])


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the links and of the groups, from the owner arrays of one text."""
    new_a, new_b = np.diff(a, prepend=-1) != 0, np.diff(b, prepend=-1) != 0
    return np.flatnonzero(new_a | new_b), np.flatnonzero(new_a & new_b)


class Grown:
    """An array that grows at its end."""

    def __init__(self) -> None:
        self.n, self.data = 0, np.zeros(1024, np.int64)

    def extend(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros(max(self.n, 2 * len(values)) + 1024, np.int64)])
        self.data[self.n : self.n + len(values)] = values
        self.n += len(values)


class Aligner:
    """Groups and links of segments, each worked out when first met; beyond `room` bytes all are forgotten."""

    def __init__(self, a_path: str, b_path: str, room: int = 150_000_000) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core already
        self.a, self.b, self.room = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path), room
        self.a.encode_special_tokens = True
        of, entries = byte_level(), self.a.get_vocab(with_added_tokens=True)
        a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            a_bytes[i] = bytes(of[c] for c in entry) if all(c in of for c in entry) else entry.encode()
        pieces = list(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ordinary = [p for i, p in enumerate(pieces) if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i))]
        if any("\n" in p or MARK in p.lstrip(MARK) for p in ordinary):
            raise ValueError(f"{b_path}: a piece goes on across white space, so texts can't be cut there")
        self.mark = self.b.piece_to_id(MARK)
        self.bytes = a_bytes, [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.sizes = tuple(np.array([len(x) for x in own]) for own in self.bytes)
        self.width = len(pieces)
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.groups: list[str] = []
        #: By segment: tokens of A and of B, groups, links and where they begin; -1 tokens where bytes differ.
        self.n_a, self.n_b, self.n_groups, self.n_links, self.first = (Grown() for _ in range(5))
        self.links = Grown()  # pairs as A's id * width + B's id
        self.weight = 0

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of texts that begin with a space or a newline. B's tokenizer puts a space before what it gets: a
        text's first space is left to it, and one before a newline is taken off again (it joins nothing there)."""
        a = [np.array(e.ids, np.int64) for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = [np.array(x, np.int64) for x in self.b.encode([t[t[0] == " " :] for t in texts], num_threads=1)]
        alone = np.array([self.mark])
        return a, [alone if t == " " else x if t[0] == " " else x[1:] for t, x in zip(texts, b)]

    def learn(self, new: list[str]) -> None:
        # segments that end with white space must not meet the next one
        joined, odd, size = [[]], [], 0
        for s in new:
            if s[-1].isspace() or MARK in s:
                odd.append(s)
            else:
                if size > _TEXT_BYTES:
                    joined.append([])
                    size = 0
                joined[-1].append(s)
                size += len(s)
        parts = [p for p in joined if p] + [[s] for s in odd]
        for at in range(0, len(parts), 256):
            own = parts[at : at + 256]
            for part, a, b in zip(own, *self.encode(["".join(p) for p in own])):
                self._hold(part, a, b)

    def _hold(self, segments: list[str], a: np.ndarray, b: np.ndarray) -> None:
        raw = [s.encode() for s in segments]
        whole = b"".join(raw)
        if not (b"".join(map(self.bytes[0].__getitem__, a)) == whole == b"".join(map(self.bytes[1].__getitem__, b))):
            if len(segments) > 1:  # which of them it is
                for s in segments:
                    self._hold([s], *(x[0] for x in self.encode([s])))
                return
            a = b = np.zeros(0, np.int64)
            raw, whole = [b""], b""
        of_a, of_b = owner_array(a, self.sizes[0]), owner_array(b, self.sizes[1])
        link, group = overlaps(of_a, of_b)
        ends = np.cumsum([0, *map(len, raw)])
        start_a, start_b = (np.concatenate([[0], np.cumsum(size[ids])])[: len(ids)] for size, ids in zip(self.sizes, (a, b)))
        n = [np.diff(np.searchsorted(x, ends)) for x in (start_a, start_b, group, link)]
        if not whole:
            n[0] = n[1] = np.array([-1])
        for grown, values in zip((self.n_a, self.n_b, self.n_groups, self.n_links), n):
            grown.extend(values)
        self.first.extend(self.links.n + np.concatenate([[0], np.cumsum(n[3])])[:-1])
        self.links.extend(a[of_a[link]] * self.width + b[of_b[link]])
        cut_a, cut_b = np.searchsorted(start_a, group).tolist(), np.searchsorted(start_b, group).tolist()
        ids_a, ids_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        text = [
            f"{ids_a[i]}|{ids_b[k]}" if j - i == 1 == m - k else f"{','.join(ids_a[i:j])}|{','.join(ids_b[k:m])}"
            for i, j, k, m in zip(cut_a, [*cut_a[1:], len(a)], cut_b, [*cut_b[1:], len(b)])
        ]
        ends = np.concatenate([[0], np.cumsum(n[2])]).tolist()
        for s, i, j in zip(segments, ends, ends[1:]):
            self.at[s] = len(self.groups)
            self.groups.append(";".join(text[i:j]))
        self.weight += 300 * len(segments) + 4 * len(whole) + 12 * len(link) + sum(map(len, text))

    def documents(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text: (tokens of A, of B, groups, links), its groups as text, and which (document, pair) occur how
        often, by document and pair."""
        if self.weight > self.room:
            self.forget()
        split = [_SEGMENT.findall(" " + t) if t else [] for t in texts]
        self.learn(sorted(set().union(*split).difference(self.at)))
        found = [list(map(self.at.__getitem__, own)) for own in split]
        segment = np.fromiter(chain.from_iterable(found), np.int64)
        document = np.repeat(np.arange(len(texts)), [len(x) for x in found])
        bad = np.bincount(document, self.n_a.data[segment] < 0, len(texts)) > 0
        if bad.any():
            found = [[] if no else x for x, no in zip(found, bad)]
            segment, document = segment[~bad[document]], document[~bad[document]]
        n = np.stack([np.bincount(document, x.data[segment], len(texts)).astype(np.int64) for x in (self.n_a, self.n_b, self.n_groups, self.n_links)])
        strings = [";".join(map(self.groups.__getitem__, x)) for x in found]
        # segments once a document, then their links
        key, times = np.unique(document << 32 | segment, return_counts=True)
        own = key & 0xFFFFFFFF
        many = self.n_links.data[own]
        row = np.repeat(np.arange(len(own)), many)
        pair = self.links.data[self.first.data[own][row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)]
        key = (key >> 32)[row] << 40 | pair
        order = np.argsort(key, kind="stable")
        key = key[order]
        begin = np.flatnonzero(np.diff(key, prepend=-1))
        total = np.add.reduceat(times[row][order], begin) if len(begin) else np.zeros(0, np.int64)
        return n, strings, (key[begin] >> 40, key[begin] & (1 << 40) - 1, total)


def align(docs: DataFrame, a_path: str, b_path: str, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups (`a1,a2|b1;a3|b2,b3`; with digest
    groups_sha256, its lowercase SHA-256, instead) and pairs, an array of (a, b, n): the id pairs that overlap in the
    document and how often.

    A encodes space + text, B the text (it adds the space itself), both without special tokens. Null and empty texts,
    and those that either tokenizer doesn't give back byte for byte (for one, B's mark in the text), have zeros, an
    empty string for either form of groups, and no pairs. Repeated rows give repeated rows, a null doc_id stays, an
    empty table gives an empty result, and other columns are not read. Whole texts, a few megabytes of them at a time."""
    groups = "groups_sha256" if digest else "groups"
    schema = f"doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, {groups} string, pairs array<struct<a: int, b: int, n: int>>"

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = held(f"aligner {a_path} {b_path}", lambda: Aligner(a_path, b_path))
        for batch in batches:
            # runs of rows of about two megabytes
            sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy().astype(np.int64)
            part = np.cumsum(sizes + 1) // 2_000_000
            edges = [*(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
            for at, to in zip([0, *edges], edges):
                n, strings, (document, pair, times) = aligner.documents(batch["text"][at:to].to_pylist())
                if digest:
                    strings = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in strings]
                ends = np.searchsorted(document, np.arange(len(strings) + 1)).astype(np.int32)
                each = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (pair // aligner.width, pair % aligner.width, times)], ["a", "b", "n"])
                out = [batch["doc_id"][at:to], *map(pa.array, n), pa.array(strings, pa.string()), pa.ListArray.from_arrays(pa.array(ends), each)]
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", groups, "pairs"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(aligned, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n_docs, best): how many of align()'s rows hold a pair, and whether none of its A id's pairs has more. As
    many rows as there are pairs of ids in use, and under one A id at most B's vocabulary."""
    counts = aligned.select(F.inline("pairs")).groupBy("a", "b").agg(F.count("*").alias("n_docs"))
    return counts.withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a")))


def alignment_support(docs: DataFrame, a_path: str, b_path: str, head: int = 100_000, digest: bool = True) -> DataFrame:
    """align()'s rows without pairs, and over each document's links n_best, how many have a pair with the most
    documents of its A id, and count_sum, the documents of their pairs summed.

    The aligned rows are written once. The `head` most usual pairs are broadcast (a fixed number, whatever the input);
    links of rarer ones meet their counts in a shuffle, where no pair has more rows than the last of the head."""
    rows = table(align(docs, a_path, b_path, digest).withColumn("_row", F.monotonically_increasing_id()))
    known = table(pair_counts(rows))
    most = F.broadcast(known.orderBy(F.desc("n_docs"), "a", "b").limit(head))
    links = rows.select("_row", F.inline("pairs"))
    rare = links.join(most, ["a", "b"], "left_anti").join(known, ["a", "b"])
    sums = (F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("n_docs")).alias("count_sum"))
    each = [x.groupBy("_row").agg(*sums) for x in (links.join(most, ["a", "b"]), rare)]
    total = each[0].unionByName(each[1]).groupBy("_row").agg(*(F.sum(c).alias(c) for c in ("n_best", "count_sum")))
    kept = [c for c in rows.columns if c not in ("_row", "pairs")]
    found = rows.select("_row", *kept).join(total, "_row", "left")
    return found.select(*kept, *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_best", "count_sum")))
