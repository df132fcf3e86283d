"""Search of texts for the names of a catalog."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

_WORD = re.compile(r"\w+")
#: So many words are looked for one by one.
FEW = 32
_DOTS = str.maketrans("İı", "ii")


def fold(text: str) -> str:
    """Two strings that match whatever their case have the same fold."""
    if "İ" in text or "ı" in text:  # translate looks at each character
        text = text.translate(_DOTS)
    return text.casefold()


@lru_cache(maxsize=20_000)
def _pattern(name: str) -> re.Pattern:
    return re.compile(rf"(?<!\w){re.escape(name)}(?!\w)", re.IGNORECASE)


class NameIndex:
    """Names (type, name, id) by the word that the fewest of them have; of such words the longest."""

    def __init__(self, names: list[tuple[str, str, str | None]]) -> None:
        split = [(n, fold(n[1]), set(_WORD.findall(fold(n[1])))) for n in names if n[1]]
        often = Counter(w for _, _, words in split for w in words)
        self.by_word: dict[str, list] = defaultdict(list)
        self.wordless = []
        for name, folded, words in split:
            if words:
                self.by_word[min(words, key=lambda w: (often[w], -len(w), w))].append((name, folded))
            else:
                self.wordless.append((name, folded))
        self.words = set(self.by_word)

    def find(self, text: str) -> Iterator[tuple[tuple, int, int]]:
        """(name, start, end) of every stand-alone occurrence in the text, in code points."""
        low = fold(text)
        # a few words are looked for one by one; many by the words that the text has
        there = [w for w in self.words if w in low] if len(self.words) <= FEW else self.words.intersection(_WORD.findall(low))
        for word in there:
            for name, folded in self.by_word[word]:
                if folded in low:
                    for m in _pattern(name[1]).finditer(text):
                        yield name, m.start(), m.end()
        for name, folded in self.wordless:
            if folded in low:
                for m in _pattern(name[1]).finditer(text):
                    yield name, m.start(), m.end()


_held: dict[str, NameIndex] = {}


def held_index(tag: str, names) -> NameIndex:
    """The index of a broadcast list of names; a Python worker keeps the one that it used last, by its tag."""
    if tag not in _held:
        _held.clear()
        _held[tag] = NameIndex(names.value)
    return _held[tag]
