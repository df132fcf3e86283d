from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from inkwell.llm.alignment import Aligner, align, alignment_support, byte_level, overlaps, owner_array

from . import helpers as H

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
IDS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def plain():
    """Groups and links of one text: both tokenizers over the whole of it, byte ranges compared one by one."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    of = byte_level()

    def ranges(parts):
        ends = np.cumsum([len(x) for x in parts]).tolist()
        return list(zip([0, *ends], ends))

    def aligned(text):
        if not text:
            return None
        e, ids_b = a.encode(" " + text, add_special_tokens=False), b.encode(text)
        bytes_a = [bytes(of[c] for c in t) for t in e.tokens]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not (b"".join(bytes_a) == b"".join(bytes_b) == b" " + text.encode()):
            return None
        ra, rb = ranges(bytes_a), ranges(bytes_b)
        links = []
        k = 0
        for i, (s, t) in enumerate(ra):
            while rb[k][1] <= s:
                k += 1
            m = k
            while m < len(rb) and rb[m][0] < t:
                links.append((e.ids[i], ids_b[m]))
                m += 1
        cuts = sorted({y for _, y in ra} & {y for _, y in rb})
        groups = []
        for s, t in zip([0, *cuts], cuts):
            groups.append(",".join(str(i) for i, r in zip(e.ids, ra) if s <= r[0] < t) + "|" + ",".join(str(i) for i, r in zip(ids_b, rb) if s <= r[0] < t))
        return len(ra), len(rb), links, groups

    return aligned


ODD = [
    None, "", " ", "  ", "\n", "a", "▁", "a ▁b", "<|endoftext|> x", "<s>a</s><unk><0x41>", "\x00\x01", "tail ", "tail  \n", "\n\nhead", "tab\t\t  x\t \ty", "nb  sp \n z",
    "\x1c. \x1c .\x1f x", "漢字と カナ\n🙂🙂 é é", "don't we'll\n'sup", "x" * 3000, " ".join("ab"[i % 2] * (i % 7) for i in range(300)), "a  b   c\n \n d", "1234567890 12.5e-3",
]


def test_segments_give_what_whole_texts_give(plain):
    rng = random.Random(2)
    letters = "aab \n\t '.,<é漢🙂1\x1c▁"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    aligner = Aligner(A, B)
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        n, strings, (document, pair, times) = aligner.documents(part)
        own = defaultdict(dict)
        for d, p, t in zip(document.tolist(), pair.tolist(), times.tolist()):
            own[d][divmod(p, aligner.width)] = t
        for i, text in enumerate(part):
            expected = plain(text)
            if expected is None:
                assert n[:, i].tolist() == [0, 0, 0, 0] and strings[i] == "" and not own[i], repr(text)
            else:
                assert n[:, i].tolist() == [expected[0], expected[1], len(expected[3]), len(expected[2])], repr(text)
                assert strings[i] == ";".join(expected[3]) and own[i] == Counter(expected[2]), repr(text)


def test_owner_arrays():
    a, b = owner_array(np.array([0, 1, 2]), np.array([1, 2, 3])), owner_array(np.array([1, 0, 1, 0]), np.array([1, 2]))
    assert a.tolist() == [0, 1, 1, 2, 2, 2] and b.tolist() == [0, 0, 1, 2, 2, 3]
    assert [x.tolist() for x in overlaps(a, b)] == [[0, 1, 2, 3, 5], [0, 3]]


def support(plain, texts):
    """(doc, sums) by the contract, from all documents' links."""
    found = [plain(t) for t in texts]
    docs = Counter(p for f in found if f for p in set(f[2]))
    most = defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            sha = hashlib.sha256(";".join(f[3]).encode()).hexdigest()
            out.append((f[0], f[1], len(f[3]), len(f[2]), sum(docs[p] == most[p[0]] for p in f[2]), sum(docs[p] for p in f[2]), sha))
    return out


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("head", [100_000, 5])
def test_counts_of_pairs(spark, plain, head):
    rows = [(r[0], r[1]) for r in H.corpus()] + [(1000 + i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, IDS).repartition(4)
    found = {r[0]: tuple(r[1:]) for r in alignment_support(docs, A, B, head=head).select(*COLUMNS).collect()}
    assert found == {d: x for (d, _), x in zip(rows, support(plain, [t for _, t in rows]))}


def test_odd_tables(spark, plain):
    big = 1 << 60
    rows = [(big + 1, "one two", "a", 1), (None, "one two", "b", 2), (big + 3, "one three", None, 3), (big + 3, "one three", "c", None), (None, None, "d", 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, pairs string, _row int").coalesce(1)
    found = sorted((tuple(r) for r in alignment_support(docs, A, B).select(*COLUMNS).collect()), key=str)
    assert found == sorted(((r[0], *x) for r, x in zip(rows, support(plain, [r[1] for r in rows]))), key=str)
    assert alignment_support(docs.limit(0), A, B).count() == 0


def test_groups_and_a_very_long_text(spark):
    text = "long texts are cut at white space. " * 600_000
    docs = spark.createDataFrame([(1, text), (2, "long texts")], IDS)
    found = {r.doc_id: r for r in align(docs, A, B).select("doc_id", "n_a", "n_links", "n_groups", "groups", "pairs").collect()}
    assert found[2].groups == ";".join(found[1].groups.split(";")[: found[2].n_groups])
    assert found[1].n_links == sum(p.n for p in found[1].pairs) and found[1].n_a > 4_000_000
