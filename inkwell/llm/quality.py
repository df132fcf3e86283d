"""Line-first cleaning: rules judge lines, failed lines go, and a document that loses too much text is rejected."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .common import long_ids, text_ids, with_text_ids

#: Words of navigation bars and phrases of boilerplate lines, lower case, in English, German, Spanish and French.
NAVIGATION = (
    "home", "about", "contact", "login", "sign in", "sign up", "register", "search", "menu", "next", "previous", "skip to content",
    "startseite", "kontakt", "anmelden", "suche", "weiter", "zurück",
    "inicio", "contacto", "iniciar sesión", "buscar", "siguiente", "anterior",
    "accueil", "connexion", "rechercher", "suivant", "précédent",
)
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of service", "terms of use", "use cookies", "javascript", "lorem ipsum",
    "subscribe", "click here", "read more", "share this", "licensed under", "released under", "powered by", "copyright",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "verwendet cookies", "hier klicken", "weiterlesen", "newsletter abonnieren",
    "todos los derechos reservados", "política de privacidad", "política de cookies", "términos de uso", "utiliza cookies", "haga clic aquí", "leer más",
    "tous droits réservés", "politique de confidentialité", "conditions d'utilisation", "utilise des cookies", "cliquez ici", "lire la suite",
)
#: What stands between the entries of a menu line, and how many bare lines in a row make a menu.
SEPARATORS = "|•·›»→"
MENU_LINES = 5
#: What may end a sentence, closing marks included.
ENDS = tuple(".!?:;…\"'”’»)]")

_nav = re.compile(r"\b(?:" + "|".join(NAVIGATION) + r")\b")
_boiler = re.compile("|".join(BOILERPLATE))
_between = re.compile("[" + SEPARATORS + r"]|\s/\s")
_link = re.compile(r"(?:https?://|www\.)\S+", re.I)
_symbols = re.compile(rb"[#*$%&|<>]")
#: Bytes that start a code point.
_count_not = bytes(range(0x80, 0xC0))

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, "
    "kept boolean, n_lines bigint, n_lines_kept bigint, n_words_kept bigint"
)


def line_fails(line: str, n_words: int, seen: bool) -> str:
    """Name of the rule that a line with words fails, or ''.

    symbols: more than one of #*$%&|<> for four words; shouting: most words end in "!!" or nine tenths of at least
    20 letters are capitals; punctuation: a line of 20 words or more has no sentence mark in or after it, or a
    line of 3 to 19 words neither ends in one nor starts like a heading; navigation: most of a line of at most 12
    words are navigation words, half of a line's words or more are links, or separators cut a line into three entries
    or more of at most three words on average; boilerplate: a line of at most 25 words has such a phrase; repeated: it
    is equal to an earlier line. What a menu looks like is told in any language, its words only in four."""
    if seen:
        return "repeated"
    if 4 * sum(map(line.count, "#*$%&|<>")) > n_words:
        return "symbols"
    if 2 * len(re.findall(r"!!+(?:\s|$)", line)) > n_words:
        return "shouting"
    upper = sum(map(str.isupper, line))
    if upper >= 18:
        letters = sum(map(str.isalpha, line))
        if letters >= 20 and 10 * upper >= 9 * letters:
            return "shouting"
    tail = line.rstrip()
    if not tail.endswith(ENDS):
        if n_words >= 20 and not any(m in line for m in ".!?…"):
            return "punctuation"
        if 3 <= n_words < 20 and not tail[:1].isupper():
            return "punctuation"
    low = line.lower()
    if n_words <= 12 and 2 * len(_nav.findall(low)) > n_words:
        return "navigation"
    if 2 * len(_link.findall(line)) >= n_words:
        return "navigation"
    if not tail.endswith(ENDS):
        entries = [e for e in _between.split(line) if e.strip()]
        if len(entries) >= 3 and n_words <= 3 * len(entries):
            return "navigation"
    if n_words <= 25 and _boiler.search(low):
        return "boilerplate"
    return ""


def judged_lines(text: str) -> list[tuple[str, int, str]]:
    """(line, its words, the rule it fails or '') of every line; a line without words fails none. MENU_LINES or more
    lines of at most three words in a row, none with a sentence mark at its end, fail as navigation."""
    seen: set[str] = set()
    out: list[tuple[str, int, str]] = []
    bare: list[int] = []
    for line in text.split("\n"):
        k = len(line.encode(errors="replace").split())
        out.append((line, k, line_fails(line, k, line in seen) if k else ""))
        if not k:
            continue
        seen.add(line)
        if k <= 3 and not line.rstrip().endswith(ENDS):
            bare.append(len(out) - 1)
            if len(bare) >= MENU_LINES:
                for at in bare if len(bare) == MENU_LINES else bare[-1:]:
                    out[at] = (*out[at][:2], out[at][2] or "navigation")
        else:
            bare = []
    return out


def _text_row(text: str, max_loss: float) -> tuple:
    raw = text.encode()
    words = raw.split()
    n = len(words)
    joined = b"".join(words)
    chars = len(joined.translate(None, _count_not))
    symbols = len(_symbols.findall(joined))
    # words in 3-word windows found twice or more
    code: dict[bytes, int] = {}
    ids = [code.setdefault(w, len(code)) for w in words]
    base = len(code)
    first: dict[int, int] = {}
    hit = bytearray(n)
    three = b"\1\1\1"
    for i in range(n - 2):
        key = (ids[i] * base + ids[i + 1]) * base + ids[i + 2]
        j = first.setdefault(key, i)
        if j != i:
            hit[i : i + 3] = three
            hit[j : j + 3] = three
    repeats = hit.count(1)
    judged = [(line, k, rule) for line, k, rule in judged_lines(text) if k]
    kept = [k for _, k, rule in judged if not rule]
    lines, kept_lines, kept_words = len(judged), len(kept), sum(kept)
    dup = lines - len({line for line, _, _ in judged})
    failed = n < 50 or 100 * repeats > 50 * n
    whole = not failed and kept_words >= (1 - max_loss) * n
    return n, chars, symbols, dup, repeats, failed, whole, lines, kept_lines, kept_words


def clean_lines(text: str | None) -> str:
    """The text without the lines that fail a rule; lines without words stay."""
    return "\n".join(line for line, _, rule in judged_lines(text or "") if not rule)


def line_quality(docs: DataFrame, max_loss: float = 0.5) -> DataFrame:
    """One row per document: the base counts, the base verdict and the line rules' verdict.

    A null or empty text counts as no words: base_failed, not kept. Repeated rows and ids give a row each, a null
    doc_id stays null, and extra columns are not read. The work is per document, in bounded batches."""

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in batches:
            rows = [(d, *_text_row(t or "", max_loss)) for d, t in zip(batch["doc_id"], batch["text"])]
            yield pd.DataFrame(rows, columns=names)

    return long_ids(with_text_ids(docs, "text").mapInPandas(judged, text_ids(SCHEMA)))
