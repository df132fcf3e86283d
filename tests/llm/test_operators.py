from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from inkwell.llm import queries as Q
from inkwell.llm.factors import remove_repeated_words
from inkwell.llm.fingerprint import fingerprints
from inkwell.llm.language import fit_language, identify
from inkwell.llm.mixing import mix_sources, mixed_documents
from inkwell.llm.neardup import near_groups
from inkwell.llm.packing import best_fit, pack, tokenised_pieces
from inkwell.llm.quality import clean_lines, line_quality
from inkwell.llm.suffixes import remove_repeats, suffix_array, suffix_arrays, without_repeats
from inkwell.llm.tokens import UnigramCounter, token_counts, zipf_vocabulary
from inkwell.llm.toxicity import BlockMaxIndex, toxicity

from . import helpers as H

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def rows():
    return H.corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, H.SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], H.SCHEMA)


def got(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_suffix_array_is_that_of_sorting():
    rng = random.Random(3)
    for _ in range(200):
        text = [rng.randint(1, 3) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_repeated_bytes(docs, rows):
    assert got(remove_repeats(docs)) == H.without_repeats(rows, 100, words=False)


def test_repeated_words(docs, rows):
    found = got(remove_repeated_words(docs))
    assert found == {d: (n, k, sha) for d, (n, k, _, sha) in H.without_repeats(rows, 20, words=True).items()}


def test_frequent_anchors_are_resolved_in_batches_and_salted(docs, rows):
    assert got(remove_repeats(docs, hot=2, batch_hot=2)) == H.without_repeats(rows, 100, words=False)
    words = {d: (n, k, sha) for d, (n, k, _, sha) in H.without_repeats(rows, 20, words=True).items()}
    assert got(remove_repeated_words(docs, hot=2, batch_hot=2)) == words


def test_suffix_arrays_of_many_texts():
    rng = random.Random(5)
    texts = [[rng.randint(1, rng.choice([1, 2, 5])) for _ in range(rng.randint(0, 40))] + [0] for _ in range(300)]
    sizes = np.array([len(t) for t in texts])
    found = suffix_arrays(np.array([x for t in texts for x in t]), sizes)
    expected = [b + i for t, b in zip(texts, np.cumsum(sizes) - sizes) for i in sorted(range(len(t)), key=lambda i: t[i:])]
    assert found.tolist() == expected


def test_rows_without_an_id_are_dealt_by_text(spark):
    from inkwell.llm.windows import NULL_ID, bucket_of, document_bucket

    rng = random.Random(7)
    keys = [(doc, rng.randrange(1 << 31)) for doc in (NULL_ID, -5, 3) for _ in range(300)]
    doc, text = (np.array(c, np.int64) for c in zip(*keys))
    own = bucket_of(doc, text.astype(np.uint32), 16)
    df = spark.createDataFrame(keys, "d bigint, t bigint").coalesce(1)
    assert [r[0] for r in df.select(document_bucket(df.d, df.t, 16)).collect()] == own.tolist()
    assert all(np.bincount(own[doc == d], minlength=16).max() < 60 for d in (NULL_ID, -5, 3))
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40))
    rows = [(None, f"{passage} {i} {'xyz'[i % 3] * 40}") for i in range(30)] + [(1, passage)]
    found = remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(found) == 31 and all((r["n_removed"] >= len(passage)) == (r["doc_id"] is None) for r in found)


def test_repeats_are_cut_from_the_documents(docs, rows):
    out = without_repeats(docs)
    assert out.dtypes == docs.dtypes
    expected = H.without_repeats(rows, 100, words=False)
    for r in out.collect():
        if r["text"] is not None and r["text"].isascii():
            assert hashlib.sha256(r["text"].encode()).hexdigest() == expected[r["doc_id"]][3] and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("words", [2, 5])
def test_near_groups(docs, rows, words):
    expected = H.near_groups(rows, words)
    assert got(near_groups(docs, words=words)) == {d: (n, c, d == c) for d, (n, c) in expected.items()}


def test_line_quality(docs, rows):
    found = {r["doc_id"]: r for r in line_quality(docs).collect()}
    for doc, text, *_ in rows:
        r, base = found[doc], H.base_counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base
        assert r["base_failed"] == (base[0] < 50 or 100 * base[4] > 50 * base[0]) and not (r["base_failed"] and r["kept"])
    assert clean_lines("A good line ends here.\nhome | about | login\nA good line ends here.\n") == "A good line ends here.\n"


def test_language(spark):
    rng, rows = random.Random(5), []
    for i in range(120):
        lang, letters = [("xx", "abcde"), ("yy", "vwxyz"), (None, "abcde")][i % 3]
        rows.append((i, " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(20)), lang))
    df = spark.createDataFrame([*rows, (500, None, "xx"), (501, "12 34 !", "yy")], "doc_id bigint, text string, lang string")
    found = {r["doc_id"]: r for r in identify(df, fit_language(df)).collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang in rows if lang)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    assert found[500]["lang_pred"] == found[501]["lang_pred"] == "und" and found[500]["score"] == 0
    assert identify(df, None).filter("lang_pred != 'und'").isEmpty()


def test_block_max_search_is_exact():
    rng = np.random.default_rng(2)
    e, q = (rng.random((n, 30)) * (rng.random((n, 30)) < 0.2) for n in (300, 50))
    e, q = (x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12) for x in (e, q))
    owner, term = np.nonzero(e)
    found, cosine = BlockMaxIndex(term, owner, e[owner, term], 30, 300, block=16).nearest(*np.nonzero(q)[::-1], q[np.nonzero(q)], 50, 7)
    full = np.round(q @ e.T, 12)
    for i in range(50):
        best = sorted(range(300), key=lambda j: (-full[i, j], j))[:7]
        assert [j for j in found[i] if j >= 0] == [j for j in best if full[i, j] > 0]
        assert np.allclose(cosine[i][found[i] >= 0], [full[i, j] for j in best if full[i, j] > 0])


def test_toxicity(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = [rng.choice(words) for _ in range(30)] + (["zzvile" + rng.choice(["o", "en", "ix"])] if bad else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        if i % 2 == 0:
            labels.append((i, 1, int(bad)))
    df = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = {r["doc_id"]: r for r in toxicity(df, marks).collect()}
    assert sum(found[i]["predicted"] == (i % 4 == 0) for i in range(400)) >= 396
    assert found[900]["predicted"] == 0 and found[900]["evidence"] == [] and len(found[0]["evidence"]) == 5
    assert {r["score"] for r in toxicity(df, marks.limit(0)).collect()} == {0.0}


def test_toxicity_uses_every_term_of_the_examples(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    common = [word() for _ in range(50)]
    rows = [(i, " ".join(rng.choice(common) for _ in range(20))) for i in range(300)]
    labels = [(i, 0, int(i % 3 == 0 and i < 90)) for i in range(300)]
    rare = [next(i for i in range(1000 + 10 * y, 1010 + 10 * y) if zlib.crc32(str(i).encode()) % 5) for y in (0, 1)]
    for y, i in enumerate(rare):  # five words that no other example has
        rows += [(i, text := " ".join(f"qz{y}{word()}" for _ in range(5))), (i + 1000, text)]
        labels.append((i, 0, y))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in toxicity(df, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()}
    for y, i in enumerate(rare):
        assert found[i + 1000]["n_terms"] >= 5
        first = found[i + 1000]["evidence"][0]
        assert (first["doc_id"], first["toxic"]) == (i, y) and abs(first["cosine"] - 1) < 1e-9
    assert found[rare[1] + 1000]["score"] > found[rare[0] + 1000]["score"]


def test_fingerprints(docs, rows):
    texts = [(d, t or "") for d, t, *_ in sorted(rows, key=lambda r: -r[0])]
    found = {r["doc_id"]: r for r in fingerprints(docs).collect()}
    by_text = defaultdict(set)
    for k, (d, t) in enumerate(texts):
        nxt, m = texts[(k + 1) % len(texts)][1], len(t) // 3
        edited = t[: len(t) - m] + nxt[:m]
        assert (found[d]["n_chars"], found[d]["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        by_text[t].add(found[d]["fingerprint"])
        a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split(), edited.split()))
        if len(a | b) > 60:
            assert abs(found[d]["near_edited"] - len(a & b) / len(a | b)) < 0.2
    assert all(len(f) == 1 for f in by_text.values())


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("ids", ["outlier", "wide", "null", "repeated", "dense"])
def test_next_document_of_any_ids(spark, ids, split):
    from pyspark.sql import functions as F

    from inkwell.llm.fingerprint import _cuts, with_next

    of = {
        "outlier": lambda i: 10**17 if i == 999 else i, "wide": lambda i: [-9 * 10**18, 9 * 10**18, (1 << 63) - 1, -(1 << 63)][i] if i < 4 else i * 7,
        "null": lambda i: None if i % 3 == 0 else i, "repeated": lambda i: 500 if i % 3 == 0 else i, "dense": lambda i: i,
    }[ids]
    rows = [(of(i), f"text {i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    cuts, heavy, whole, _ = _cuts(df, 50, 8192, 1 << 27)
    assert bool(heavy) == (ids in ("null", "repeated")) and len(cuts) >= 10 and whole == 1
    small = {"buckets": 20, "bucket_bytes": 400} if split else {}
    assert not split or _cuts(df, 50, **small)[2] > 5
    out = with_next(df, ["doc_id", "text"], rows_per_bucket=3 if split else 50, **small).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in out) == sorted((d is None, d or 0, t) for d, t in rows)
    after = {(r["doc_id"], r["text"]): (r["next_doc_id"], r["next_text"]) for r in out}
    at, seen = (out[0]["doc_id"], out[0]["text"]), []
    for _ in rows:  # one cycle over all rows, in descending order but for one step
        seen.append(at)
        at = after[at]
    assert len(set(seen)) == len(rows) and at == seen[0]
    key = [-(1 << 64) if d is None else d for d, _ in seen]
    assert sum(b > a for a, b in zip(key, [*key[1:], key[0]])) == 1
    sizes = df.withColumn("packed", F.lit(1))
    assert with_next(sizes, ["packed"], rows_per_bucket=50).filter("next_packed = 1").count() == len(rows)


def test_fingerprints_estimate_likeness(spark):
    from pyspark.sql import functions as F

    from inkwell.llm.fingerprint import likeness, packed_minhash

    rng, rows = random.Random(9), []
    for k in range(120):  # similarities from 0 to 1, short texts with many empty bins too
        n, share = rng.choice([12, 60, 400]), k % 11 / 10
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        rows.append((" ".join(words), " ".join(words[: int(n * share)] + [f"v{rng.randrange(10**6)}" for _ in range(n - int(n * share))])))
    found = spark.createDataFrame(rows, "a string, b string").select("a", "b", likeness(packed_minhash(F.col("a")), packed_minhash(F.col("b"))).alias("l")).collect()
    errors = []
    for a, b, x in found:
        s, t = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
        errors.append(x - len(s & t) / len(s | t))
    assert max(map(abs, errors)) < 0.25 and (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.08 and abs(sum(errors) / len(errors)) < 0.03


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, expected = Tokenizer.from_file(path), {}
    for d, t, *_ in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for p in range(0, len(ids), 128):
            expected[d, p // 128] = (p, len(ids[p : p + 128]), zlib.crc32(ids[p : p + 128].tobytes()))
    out = pack(tokenised_pieces(docs, path, length=128), tokens=128).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in out} == expected
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]] and sum(n for _, n in own) <= 128
    assert len(bins) <= -(-sum(n for own in bins.values() for _, n in own) // 128) + 2


def test_packing_holds_every_constraint():
    b, _ = best_fit(np.array([5] * 20), tokens=100, documents=3, attention=60.0)
    assert np.bincount(b).max() <= 2  # 25 of attention each


def test_token_counts(docs, rows):
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    own = Tokenizer(models.Unigram(zipf_vocabulary(path), unk_id=0, byte_fallback=False))
    own.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(r"[\x20\x09-\x0D]+"), "removed"), pre_tokenizers.Metaspace("▁", "always", False)])
    found = got(token_counts(docs, path))
    assert all(found[d][2] == len(own.encode(t or "").ids) for d, t, *_ in rows)
    tied = [("<unk>", 0.0), ("a", -1.0), ("aa", -2.0), ("b", -1.0), ("ab", -2.0)]
    rng, counter = random.Random(8), UnigramCounter(tied)
    plain = Tokenizer(models.Unigram(tied, unk_id=0))
    for _ in range(300):
        text = "".join(rng.choice("abz漢") for _ in range(rng.randint(1, 12)))
        assert counter.pieces(text) == len(plain.encode(text).ids)


def test_mixing(docs, rows):
    out = mix_sources(docs).collect()
    size = {d: len(H.WORD.findall(t or "")) for d, t, *_ in rows}
    totals, taken = defaultdict(int), defaultdict(int)
    for d, _, _, source, *_ in rows:
        totals[source] += size[d]
    for r in out:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == totals[r["source"]] and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    names = sorted((s for s in totals if s is not None)) + [None] * (None in totals)
    weight, open_, target, left = {s: k % 3 + 1 for k, s in enumerate(names)}, set(names), {}, sum(totals.values())
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 3 * totals[s]}
        if not full:
            break
        for s in full:
            target[s] = 3 * totals[s]
            left -= target[s]
        open_ -= full
    target |= {s: weight[s] * level for s in open_}
    for r in out:
        assert abs(r["target"] - target[r["source"]]) < 1e-6
    assert all(abs(taken[s] - target[s]) <= 32 for s in names)
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, mix_sources(docs.repartition(3)).collect()), key=repr)
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = sum(len(H.WORD.findall(r["text"])) for r in mixed.collect())
    assert words == sum(taken.values())


def test_odd_inputs(spark, docs, nothing, rows):
    path, pieces = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
    labels = spark.createDataFrame([(1, 0, 1), (4, 1, 0)], "doc_id bigint, quality int, toxic int")
    again = docs.unionByName(docs.filter("doc_id % 2 = 0")).unionByName(spark.createDataFrame([(None, "no id", None, None, 5, "b"), (None, None, None, None, None, None)], H.SCHEMA))
    for f in (
        remove_repeats, remove_repeated_words, without_repeats, near_groups, line_quality, fingerprints, mix_sources, lambda d: identify(d, fit_language(d)),
        lambda d: toxicity(d, labels), lambda d: pack(tokenised_pieces(d, path)), lambda d: token_counts(d, pieces),
    ):
        assert f(nothing).count() == 0
        assert f(again).count() >= again.count()


def test_registered():
    assert {k.split("_")[0] for k in Q.QUERIES} == {f"op{i}" for i in range(1, 14)}


def _exact(spark):
    """Ids that a double can't hold, beside a null, repeated rows and columns whose names operators use inside."""
    big = 1 << 60
    filler = " ".join(f"filler{i}" for i in range(60))
    long = " ".join(f"w{i % 5000}x{i % 37}" for i in range(300_000))
    rows = [
        (big + 1, "the first text has a passage " + filler, "en", "s1", big + 5, "b", 1, None), (None, "no id here " + filler, "en", None, None, None, None, big + 7),
        (big + 3, "another one, it repeats the passage " + filler + " and ends.", "de", "s2", big + 9, "c", 2, 5), (big + 3, "another one, it repeats the passage " + filler + " and ends.", "de", "s2", big + 9, "c", 2, 5),
        (big + 2, None, None, "s1", 0, None, None, None), (5, "", "de", "s1", 0, "", 0, 0), (7, long, "en", "s1", len(long), "long", 3, 1),
    ]
    return rows, spark.createDataFrame(rows, H.SCHEMA + ", row bigint, part bigint").coalesce(1)


def test_ids_and_other_longs_are_exact(spark):
    rows, docs = _exact(spark)
    path, pieces = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
    labels = spark.createDataFrame([(r[0], 0, i % 2) for i, r in enumerate(rows) if r[0]], "doc_id bigint, quality int, toxic int")
    ids = sorted((r[0] for r in rows), key=repr)
    own = {
        "op1": remove_repeats(docs), "op2": line_quality(docs), "op3": identify(docs, fit_language(docs)), "op4": toxicity(docs, labels), "op5": remove_repeated_words(docs), "op6": fingerprints(docs),
        "op7": pack(tokenised_pieces(docs, path)).filter("piece = 0"), "op8": near_groups(docs), "op9": token_counts(docs, pieces), "op10": mix_sources(docs), "without": without_repeats(docs), "identified": identify(docs, fit_language(docs), keep_rows=True),
    }
    found = {name: df.cache() for name, df in own.items()}
    for name, df in found.items():
        assert sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=repr) == ids, name
    by = {r["doc_id"]: r for r in found["op1"].collect()}
    # repeated rows are one document, a null id comes last
    brute = H.without_repeats([(d if d is not None else 1 << 62, t) for d, t, *_ in dict.fromkeys(r[:2] for r in rows)], 100, words=False)
    assert {(d if d is not None else 1 << 62): (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in by.items()} == brute
    words = {(r["doc_id"] if r["doc_id"] is not None else 1 << 62): (r.n_words, r.n_removed, r.kept_sha256) for r in found["op5"].collect()}
    assert words == {d: (n, k, sha) for d, (n, k, _, sha) in H.without_repeats([(d if d is not None else 1 << 62, t) for d, t, *_ in dict.fromkeys(r[:2] for r in rows)], 20, words=True).items()}
    counts = {r["doc_id"]: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found["op2"].collect()}
    assert counts == {d: H.base_counts(t) for d, t, *_ in rows}
    groups = H.near_groups([r[:2] for r in rows if r[0] is not None], 5)
    assert {(r["doc_id"], r.n_shingles, r.component_id) for r in found["op8"].collect() if r["doc_id"] is not None} == {(d, n, c) for d, (n, c) in groups.items()}
    left = sorted(((r["doc_id"], r["lang"], r["source"], r["bucket"], r["row"], r["part"]) for r in found["without"].collect()), key=repr)
    assert left == sorted(((r[0], r[2], r[3], r[5], r[6], r[7]) for r in rows), key=repr)
    assert all(r["n_chars"] == len(r["text"] or "") for r in found["without"].collect())
    kept = pack(docs.selectExpr("doc_id", "n_chars", "bucket", "`row`", "part", "cast(3 as bigint) as length", "cast(null as int) as small")).collect()
    assert sorted((tuple(r)[:5] for r in kept), key=repr) == sorted(((r[0], r[4], r[5], r[6], r[7]) for r in rows), key=repr)
    scores = {r["doc_id"]: r for r in found["op4"].collect()}
    assert {e.doc_id for r in scores.values() for e in r.evidence or []} <= set(ids)
    for df in found.values():
        df.unpersist()


def test_codewords_stay_apart():
    from inkwell.llm.language import codewords

    for n, bits in ((2, 31), (4, 31), (40, 41), (300, 55)):
        c = codewords(n, bits)
        assert c.shape == (n, bits) and set(np.unique(c)) == {-1, 1}
        assert min((c[i] != c[j]).sum() for i in range(n) for j in range(i)) >= (7 if n > 2 else 20)


@pytest.mark.parametrize("percent", [80, 50])
def test_prefixes_find_every_linked_pair_once_or_more(spark, percent):
    from inkwell.llm.neardup import _linked, _partners

    rng, sets = random.Random(percent), {}
    for base in range(12):
        core = [rng.randrange(400) for _ in range(rng.randint(1, 60))]
        for _ in range(6):
            sets[len(sets)] = sorted({rng.randrange(400) if rng.random() < 0.08 else x for x in core})
    items = spark.createDataFrame(list(sets.items()), "node bigint, items array<bigint>")
    nodes = spark.createDataFrame([(k, k % 5) for k in sets], "node bigint, comp bigint")
    found = {(r["a"], r["b"]) for r in _linked(_partners(nodes, items, percent), items, percent).collect()}
    linked = {(a, b) for a in sets for b in sets if a % 5 < b % 5 and 100 * len({*sets[a]} & {*sets[b]}) >= percent * len({*sets[a]} | {*sets[b]})}
    assert found == linked and len(linked) > 20


@pytest.mark.parametrize("percent, long", [(80, (2, 2, 2)), (50, (2, 2, 2)), (80, (8,)), (60, (1, 1, 1, 1, 1))])
def test_long_lists_lose_no_link(spark, monkeypatch, percent, long):
    """Rounds around one node of a list find links between all components that brute force links, and no other ones."""
    from inkwell.llm import neardup

    monkeypatch.setattr(neardup, "LONG", long)
    rng, sets = random.Random(percent + len(long)), {}
    for base in range(5):
        core = rng.sample(range(600), rng.randint(30, 60))
        for _ in range(30):
            sets[len(sets)] = sorted({rng.randrange(600) if rng.random() < rng.choice([0.02, 0.06, 0.2]) else x for x in core})
    items = spark.createDataFrame(list(sets.items()), "node bigint, items array<bigint>")
    comp = {k: rng.choice([k, k // 4]) for k in sets}
    nodes = spark.createDataFrame(list(comp.items()), "node bigint, comp bigint")
    linked = {(comp[a], comp[b]) for a in sets for b in sets if a < b and 100 * len({*sets[a]} & {*sets[b]}) >= percent * len({*sets[a]} | {*sets[b]})}

    def joined(links):
        up = {c: c for c in comp.values()}

        def root(c):
            return c if up[c] == c else root(up[c])

        for a, b in links:
            up[max(root(a), root(b))] = min(root(a), root(b))
        return {c: root(c) for c in up}

    found = neardup._ties(nodes, items, percent).collect()
    assert joined((r["a"], r["b"]) for r in found) == joined(linked) and len(linked) > 20


def test_near_copies_under_the_threshold_are_not_paired(spark, monkeypatch):
    """400 copies of one text, most of them just too different from each other: pairs that reach the sets stay few."""
    from inkwell.llm import neardup

    rng, seen, real = random.Random(7), [], neardup._linked
    base = [f"word{i}" for i in range(80)]
    rows = []
    for i in range(400):
        words = list(base)
        for at in rng.sample(range(80), 0 if i < 2 else rng.randint(4, 7)):
            words[at] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))

    def counted(pairs, sets, percent):
        seen.append(pairs.count())
        return real(pairs, sets, percent)

    monkeypatch.setattr(neardup, "_linked", counted)
    out = neardup.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), words=2).collect()
    brute = H.near_groups(rows, 2)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute
    assert len({c for _, c in brute.values()}) > 20
    assert sum(seen) < 6000, seen
