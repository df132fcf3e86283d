"""Token counts of a unigram tokenizer without making its tokens.

A text's pieces are found word by word (white space never lies inside a piece): an Aho-Corasick automaton lists the
vocabulary's matches, and dynamic programming carries, for every end of a match, the best score and that path's
number of pieces. Ties go as in the tokenizer: of equal scores the piece that starts first, an unknown character
only where no single-character piece starts, neighbouring unknown ones as one piece.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .common import held, long_ids, text_ids, with_text_ids

SCHEMA = "doc_id bigint, n_bytes bigint, n_words bigint, n_tokens bigint"
MARK = "▁"  # stands for the white space before a word
#: Fixed value: what an unknown character scores below the worst piece, as in the unigram tokenizer.
UNKNOWN_PENALTY = 10.0


def zipf_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model's ordinary pieces, those with the mark only in front, after "<unk>";
    scores are logarithms of Zipf's law over the pieces' order (the public vocabularies have no unigram scores)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    pieces = [p for p in map(model.id_to_piece, ids) if MARK not in p[1:]]
    whole = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    return [("<unk>", 0.0), *((p, -math.log(r) - whole) for r, p in enumerate(pieces, 1))]


class UnigramCounter(dict):
    """Numbers of pieces of words (bytes, without the mark), each worked out when first asked for; at most `limit`
    are remembered from one batch to the next."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: int = 0, limit: int = 500_000) -> None:
        import ahocorasick

        super().__init__()
        self.limit = limit
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(vocabulary):
            if piece:
                self.automaton.add_word(piece, (len(piece), score, i == unknown))
        self.automaton.make_automaton()

    def pieces(self, text: str) -> int:
        """Number of pieces of a text (a word with its mark)."""
        n = len(text)
        if not n:
            return 0
        best: list[float | None] = [None] * (n + 1)
        count, last_unknown = [0] * (n + 1), [False] * (n + 1)
        best[0] = 0.0
        matches = self.automaton.iter(text)
        pending = next(matches, None)
        for end in range(1, n + 1):
            single, top = False, None
            # matches come by end, the longest first: the order of their starts
            while pending is not None and pending[0] == end - 1:
                length, score, unknown = pending[1]
                begin = end - length
                if length == 1:
                    single = True
                value = score + best[begin]
                if top is None or value > top:
                    top, n_top, u_top = value, count[begin] + (not (unknown and last_unknown[begin])), unknown
                pending = next(matches, None)
            if not single:
                value = self.unknown + best[end - 1]
                if top is None or value > top:
                    top, n_top, u_top = value, count[end - 1] + (not last_unknown[end - 1]), True
            best[end], count[end], last_unknown[end] = top, n_top, u_top
        return count[n]

    def __missing__(self, word: bytes) -> int:
        self[word] = n = self.pieces(MARK + word.decode(errors="replace"))
        return n

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_words, n_tokens.

    Words are what stands between space and the ASCII controls 9 to 13. A null or empty text, or one of white space
    only, has no tokens; repeated rows count alike; a null doc_id stays. An empty table gives an empty result; other
    columns are not read. Whole texts count, in batches of bounded size; nothing is shuffled."""

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = held(f"pieces {vocabulary_path}", lambda: UnigramCounter(zipf_vocabulary(vocabulary_path)))
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                raw = [t.encode(errors="replace") if isinstance(t, str) else b"" for t in part["text"]]
                words = [t.split() for t in raw]
                counter.trim()
                known = counter.__getitem__
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"], "n_bytes": [len(t) for t in raw],
                        "n_words": [len(w) for w in words], "n_tokens": [sum(map(known, w)) for w in words],
                    }
                )

    return long_ids(with_text_ids(docs, "text").mapInPandas(counts, text_ids(SCHEMA)))
