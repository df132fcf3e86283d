from __future__ import annotations

import pytest

from inkwell.llm.quality import clean_lines, judged_lines, line_quality

from .helpers import SCHEMA, WORD, base_counts, corpus

PROSE = "The committee met on Tuesday and agreed on the budget for the coming year."


@pytest.mark.parametrize(
    "line, rule",
    [
        (PROSE, ""), ("Budget for the coming year", ""), ("Ja.", ""), ("Was kostet das?", ""), ("", ""), ("  \t", ""),
        ("Produkte | Preise | Jobs | Presse", "symbols"), ("Produits • Tarifs • Emplois • Presse", "navigation"), ("Inicio › Libros › Novela histórica", "navigation"),
        ("Paris / Lyon / Nice", "navigation"), ("Er kam, sah und siegte • so heißt es • sagt man.", ""), ("A · B", ""),
        ("https://a.example/x www.b.example", "navigation"), (f"{PROSE} https://a.example", ""),
        ("Startseite Kontakt Suche", "navigation"), ("Tous droits réservés, Dupont et fils.", "boilerplate"), ("Alle Rechte vorbehalten.", "boilerplate"),
        ("Todos los derechos reservados.", "boilerplate"), ("und dann kam er nicht mehr", "punctuation"), ("BUY NOW AND SAVE MORE TODAY FRIENDS.", "shouting"),
    ],
)
def test_rules(line, rule):
    assert [r for _, _, r in judged_lines(line)] == [rule]


def test_short_lines_in_a_row_are_a_menu():
    menu = ["Obst", "Gemüse", "Brot und Käse", "Fisch", "Wein"]
    assert [r for _, _, r in judged_lines("\n".join(menu[:4]))] == [""] * 4
    assert [r for _, _, r in judged_lines("\n".join([*menu, "Tee"]))] == ["navigation"] * 6
    assert [r for _, _, r in judged_lines("\n".join([*menu[:3], "", *menu[3:]]))] == ["navigation"] * 3 + [""] + ["navigation"] * 2  # blank lines don't end a menu
    assert not any(r for _, _, r in judged_lines("\n".join([*menu[:3], PROSE, *menu[3:]])))
    assert clean_lines("\n".join([*menu, PROSE])) == PROSE and clean_lines(None) == ""


def test_verdict_follows_from_what_is_left(spark):
    menu = "\n".join(f"Punkt {i}" for i in range(80))
    rows = [*corpus(), (901, f"{menu}\n{PROSE}", "de", "s1", 1, "b"), (902, "\n".join(f"{PROSE} Item {i} was number {i * 7}." for i in range(9)), "en", "s1", 1, "b"), (None, PROSE, None, None, None, None)]
    want = []
    for doc, text, *_ in rows:
        n, chars, symbols, dup, repeats = base_counts(text)
        failed = n < 50 or 100 * repeats > 50 * n
        left = len(WORD.findall(clean_lines(text)))
        want.append((doc, n, chars, symbols, dup, repeats, failed, not failed and 2 * left >= n, left))
    found = [tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_words_kept")) for r in line_quality(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert not next(r for r in found if r[0] == 901)[7]
