"""Near-duplicate groups by SetSketch registers, banding, likelihood estimates and exact checks.

A document's set is that of its lower-cased word shingles. Documents with equal sets are one node, named by a 64-bit
hash of the set's 128-bit signature and size.
A node's sketch has REGISTERS registers: each is floor(1 - log_b h) of the least exponentially distributed hash h of
the set, cut to 0..LIMIT, so that sketches of a union are the maxima. Bands of ROWS registers give candidates; with
BANDS bands a pair of similarity 0.8 shares none with probability (1 - 0.8 ** ROWS) ** BANDS, about 1e-7 if registers
were independent; they are odd multiples of one hash, so tests measure the recall.

No bucket's pairs are listed. First each bucket's members are compared with its first one, which settles most
buckets. The nodes of buckets that still hold several components look for partners by prefixes: with shingles in one
order for all nodes (first those of one component only, then by how many nodes have them), two sets that are linked
share one of the first n - ceil(percent * n / 100) + 1 of each. Shingles of one component only find nothing, so members
of a large group don't look for each other. Where many prefixes share a shingle, the nodes are near copies of one text,
mostly: they are set against one of them and meet by what tells them from it, which near copies seldom share. A pair is compared by sketches first (joint maximum likelihood of the
similarity, given both exact sizes), and linked only by its full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, cut, let_go, long_ids, mix, table, text_ids, with_text_ids, words_of

BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 2
#: Far below 0.8 by more than five standard errors of the estimate.
LEAST_ESTIMATE = 0.64
#: Items of its prefix that a row holds beside its own.
EARLIER = 2
#: Prefixes that may share an item in each round before its nodes are set against one of them instead of paired.
LONG = (32, 256, 2048)
#: Odd multipliers, one a register.
_ODD = (mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def shingle_sets(texts: list[bytes], words: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes): each text's distinct shingles in ascending order, texts in a row. Fewer words than a shingle
    are one shingle; no words are none."""
    value, text, _, _ = words_of(texts, lower=True)
    n = np.bincount(text, minlength=len(texts))
    gram = value.copy()
    for k in range(1, words):
        m = max(0, len(value) - k)
        gram[:m] = mix(gram[:m] ^ (value[k:] * np.uint64(2 * k + 1)))
    ends = np.cumsum(n)
    from_end = ends[text] - np.arange(len(text)) if len(text) else np.zeros(0, np.int64)
    whole = from_end >= words
    short = (n[text] < words) & (from_end == n[text])
    if short.any():  # the words there are, as one shingle
        for i in np.flatnonzero(short):
            h = np.uint64(n[text[i]])
            for v in value[i : i + n[text[i]]]:
                h = mix(np.array([h ^ v], np.uint64))[0]
            gram[i] = h
    use = whole | short
    gram, text = gram[use], text[use]
    order = np.lexsort((gram, text))
    gram, text = gram[order], text[order]
    new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])]) if len(gram) else np.zeros(0, bool)
    return gram[new], np.bincount(text[new], minlength=len(texts))


def registers(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sketches of non-empty sets that stand in a row, one line of REGISTERS uint16 each."""
    begin = np.cumsum(sizes) - sizes
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.empty((len(sizes), REGISTERS), np.uint32)
    # a few sets at a time, so that they stay in cache over all registers
    cut_at = np.flatnonzero(np.diff(begin // 16384, prepend=-1))
    for s, e in zip(cut_at, [*cut_at[1:], len(sizes)]):
        lo, hi = int(begin[s]), int(begin[e - 1] + sizes[e - 1])
        part, at = x[lo:hi], begin[s:e] - lo
        for r in range(REGISTERS):
            least[s:e, r] = np.minimum.reduceat(part * _ODD[r], at)
    h = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(h) / np.log(BASE)) + 20_000, 0, LIMIT).astype("<u2")


def estimated(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Joint maximum likelihood of the Jaccard similarity from how many registers are larger, smaller and equal."""
    up, down = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - up - down
    u = size_a / (size_a + size_b)
    v = 1 - u
    grid = np.linspace(0, 1, 201)[None, :] * np.minimum(u / v, v / u)[:, None]

    def share(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12, 1)

    p, q = share(u[:, None] - v[:, None] * grid), share(v[:, None] - u[:, None] * grid)
    like = up[:, None] * np.log(p) + down[:, None] * np.log(q) + same[:, None] * np.log(np.clip(1 - p - q, 1e-12, 1))
    return grid[np.arange(len(a)), like.argmax(axis=1)]


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        for batch in batches:
            texts = [t.encode() if isinstance(t, str) else b"" for t in batch["text"]]
            ids = batch["doc_id"]
            for i, j in chunks(texts, 2_000_000):
                own = texts[i:j]
                first: dict[bytes, int] = {}
                at = [first.setdefault(t, len(first)) for t in own]  # equal texts are sketched once
                sets, sizes = shingle_sets(list(first), words)
                some = sizes > 0
                regs = np.zeros((len(sizes), REGISTERS), "<u2")
                if some.any():
                    regs[some] = registers(sets, sizes[some])
                begin = np.cumsum(sizes) - sizes
                sums = np.concatenate([[0], np.cumsum(mix(sets), dtype=np.uint64)]).astype(np.uint64)
                more = np.concatenate([[0], np.cumsum(mix(sets ^ np.uint64(0x5555555555555555)), dtype=np.uint64)]).astype(np.uint64)
                sig = [(s[begin + sizes] - s[begin]).astype(np.int64) for s in (sums, more)]
                lines = [r.tobytes() if k else None for r, k in zip(regs, some)]
                yield pd.DataFrame({"doc_id": ids[i:j].to_numpy(), "th": batch["th"].iloc[i:j].to_numpy(), "n": sizes[at], "sig1": sig[0][at], "sig2": sig[1][at], "regs": [lines[k] for k in at]})

    schema = "doc_id bigint, th bigint, n bigint, sig1 bigint, sig2 bigint, regs binary"
    return long_ids(with_text_ids(docs, "text", F.xxhash64("text").alias("th")).mapInPandas(sketch, text_ids(schema)))


PAIR = "a bigint, b bigint, ca bigint, cb bigint"
_PAIR = ["a", "b", "ca", "cb"]


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of (a, b, ca, cb), those whose sketches make a link possible."""
    side = nodes.select("node", "n", "regs")
    joined = pairs.join(side.withColumnsRenamed({"node": "a", "n": "na", "regs": "ra"}), "a").join(side.withColumnsRenamed({"node": "b", "n": "nb", "regs": "rb"}), "b")
    joined = joined.filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * 80)

    def likely(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            if len(p):
                ra, rb = (np.frombuffer(b"".join(p[c]), "<u2").reshape(len(p), REGISTERS) for c in ("ra", "rb"))
                keep = estimated(ra, rb, p["na"].to_numpy(float), p["nb"].to_numpy(float)) >= LEAST_ESTIMATE
                yield p.loc[keep, _PAIR]

    return joined.select(*_PAIR, "na", "nb", "ra", "rb").mapInPandas(likely, PAIR)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of (a, b, ca, cb), those with 100 * intersection >= percent * union of their full sets."""
    joined = pairs.join(sets.withColumnsRenamed({"node": "a", "items": "sa"}), "a").join(sets.withColumnsRenamed({"node": "b", "items": "sb"}), "b")

    common = F.size(F.array_intersect("sa", "sb"))
    return joined.filter(common * (100 + percent) >= (F.size("sa") + F.size("sb")) * percent).select(*_PAIR)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of links (a, b): the smallest node reachable.

    Every round sends the least label known in each neighbourhood to all of it (so that stars fold into their
    centre), then follows each label to its own label; paths halve, and the rounds end when nothing changes. Each
    round's labels are written to the shared folder; only whether something changed reaches the driver."""
    edges = table(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component"))
    while True:
        label = table(label)
        seen = edges.join(label.select(F.col("node").alias("b"), F.col("component").alias("c")), "b").groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c"))
        near = label.join(seen, "node", "left").select("node", F.col("component").alias("old"), F.least("component", "c").alias("component"))
        jump = label.select(F.col("node").alias("component"), F.col("component").alias("up"))
        new = table(near.join(jump, "component", "left").select("node", "old", F.least("component", "up").alias("component")))
        if new.filter("old != component").isEmpty():
            return new.select("node", "component")
        label = new.select("node", "component")


def _prefixes(rows: DataFrame, percent: int) -> DataFrame:
    """The items of prefixes, a row each, of rows (pivot, node, comp, n, w, need, items): `left` items from it on, `own`
    of the node's component only, and the EARLIER ones before it.

    Two nodes of one pivot are linked if 2 * (100 + percent) * common items >= w + w; `need` is the least sum that a
    node meets in any that it has to find."""
    rows = rows.select("pivot", "node", "comp", "n", "w", "need", F.size("items").alias("size"), F.explode("items").alias("item"))
    found = rows.groupBy("pivot", "item").agg(F.count("*").alias("nodes"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 != c1")
    cross = rows.join(found.select("pivot", "item", "nodes"), ["pivot", "item"])
    mine = Window.partitionBy("pivot", "node")
    # items of one component only stand first: they are the node's others
    own = F.col("size") - F.count("*").over(mine)
    left = F.col("size") - F.col("own") - F.row_number().over(mine.orderBy("nodes", "item")) + 1
    earlier = F.collect_list("item").over(mine.orderBy("nodes", "item").rowsBetween(-EARLIER, -1))
    prefix = cross.withColumn("own", own).withColumns({"left": left, "earlier": earlier}).filter(F.col("left") * (2 * (100 + percent)) >= F.col("need"))
    return table(prefix.select("pivot", "item", "node", "comp", "n", "w", "left", "own", "earlier"))


def _met(prefix: DataFrame, percent: int) -> DataFrame:
    """(a, b, ca, cb) of different components that meet at an item.

    Two nodes meet at each item that their prefixes share. A row also holds the items before it in its prefix: where
    both sides hold one of them, the two have met there already, so that pair's row here is left out."""
    a, b = (prefix.select("pivot", "item", *(F.col(c).alias(c + k) for c in ("node", "comp", "n", "w", "left", "earlier"))) for k in "ab")
    # from these places on both must still hold enough in common
    enough = F.least("lefta", "leftb") * (2 * (100 + percent)) >= F.col("wa") + F.col("wb")
    pairs = a.join(b, ["pivot", "item"]).filter((F.col("compa") < F.col("compb")) & enough & ~F.arrays_overlap("earliera", "earlierb") & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent))
    return pairs.select(F.col("nodea").alias("a"), F.col("nodeb").alias("b"), F.col("compa").alias("ca"), F.col("compb").alias("cb"))


def _whole(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Open nodes (node, comp) with their whole sets, as _prefixes takes them."""
    n = F.size("items").cast("bigint")
    need = F.floor(n * (2 * percent * (100 + percent)) / 100)
    return open_.join(sets, "node").select(F.lit(0).cast("bigint").alias("pivot"), "node", "comp", n.alias("n"), (n * (2 * percent)).alias("w"), need.alias("need"), "items")


def _partners(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, ca, cb) of open nodes (node, comp) of different components: all that could be linked, by prefixes."""
    return _met(_prefixes(_whole(open_, sets, percent), percent), percent).distinct()


def _around(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Members (pivot, node, comp, n) with the items that tell their sets from their pivot's, as _prefixes takes them,
    and links (a, b) of components.

    With d such items each, two sets differ by d + d - 2 * common ones, so they are linked if 2 * (100 + percent) *
    common >= w + w, where w = (100 + percent) * d - (100 - percent) * n. The member of the least w is linked with all
    whose sum with it is 0 or less, and any two whose sum is 0 or less are among these: one link a member stands for
    all their pairs. Each other pair has one outside at least, and common items."""
    q, r = 100 + percent, 100 - percent
    sides = members.join(sets, "node").join(sets.withColumnsRenamed({"node": "pivot", "items": "centre"}), "pivot")
    items = F.concat(F.array_except("items", "centre"), F.array_except("centre", "items"))
    apart = sides.select("pivot", "node", "comp", "n", items.alias("items")).withColumn("w", F.size("items") * q - F.col("n") * r)
    apart = table(apart)
    middle = apart.groupBy("pivot").agg(F.min(F.struct("w", "comp")).alias("m")).select("pivot", F.col("m.w").alias("w0"), F.col("m.comp").alias("comp0"))
    apart = apart.join(table(middle), "pivot").withColumn("inside", F.col("w") + F.col("w0") <= 0)
    links = apart.filter("inside and comp != comp0").select(F.col("comp0").alias("a"), F.col("comp").alias("b")).distinct()
    # those inside look for some outside, whose w is over -w0; those outside for any, which must have enough items
    outside = F.greatest(F.col("w") + F.col("w0"), F.col("w") * 2 - F.expr(f"n * 100 div {percent}") * (2 * r))
    need = F.when(F.col("inside"), F.col("w") - F.col("w0")).otherwise(outside)
    return apart.select("pivot", "node", F.when(F.col("inside"), F.col("comp0")).otherwise(F.col("comp")).alias("comp"), "n", "w", need.alias("need"), "items"), links


def _ties(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components of open nodes (node, comp), which join whatever linked pairs of them join.

    Nodes that meet at an item of few prefixes are paired. Those of a longer list are set against one of them, that with
    fewest items of its own, and meet in the next round by the items that tell them from it. The last round pairs all."""
    rows, pairs, links = _whole(open_, sets, percent), [], []
    for long in (*LONG, None):
        prefix = _prefixes(rows, percent)
        lists = prefix.groupBy("pivot", "item").agg(F.count("*").alias("nodes"), F.min(F.struct("own", "node")).alias("first"))
        lists = table(lists.filter(F.col("nodes") > F.lit(long)).select("pivot", "item", F.col("first.node").alias("next")))
        if lists.isEmpty():
            pairs.append(_met(prefix, percent))
            break
        pairs.append(_met(prefix.join(lists, ["pivot", "item"], "left_anti"), percent))
        members = prefix.join(lists, ["pivot", "item"]).select(F.col("next").alias("pivot"), "node", "comp", "n").distinct()
        rows, more = _around(members, sets, percent)
        links.append(more)
    new = _linked(reduce(DataFrame.unionByName, pairs).distinct(), sets, percent)
    return table(reduce(DataFrame.unionByName, links, new.select(F.col("ca").alias("a"), F.col("cb").alias("b"))))


def _spread(buckets: DataFrame, comp: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the buckets with their node's component, and the keys of buckets in several components with their
    centre's (first's)."""
    at = buckets.join(comp, "node", "left").select("key", "first", "node", F.coalesce("component", "node").alias("comp"))
    ends = at.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.max(F.when(F.col("node") == F.col("first"), F.col("comp"))).alias("centre"))
    return at, ends.filter("c0 != c1").select("key", "centre")


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Shingles of `words` words; documents are linked with 100 * intersection >= percent * union, and component_id is
    the smallest doc_id reachable. Without words a document is linked with nothing: its component is itself. Rows of
    one id are one document with a row each: if their texts differ, it is linked with all that any of them is linked
    with. A null id cannot be reached or named: such a row stays alone, with a null component, and is kept. An empty
    table gives an empty result; extra columns are not read."""
    sketched = cut(_sketches(docs, words).withColumn("node", F.xxhash64("sig1", "sig2", "n")).drop("sig1", "sig2"))
    named = sketched.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    # equal sets are one node: map-side combined, only the least id of each set and one sketch move
    nodes = cut(named.groupBy("node", "n").agg(F.min(F.struct("doc_id", "th", "regs")).alias("x")).select("node", "n", "x.doc_id", "x.th", "x.regs"))
    bands = F.array(*(F.xxhash64(F.lit(i), F.substring("regs", 2 * ROWS * i + 1, 2 * ROWS)) for i in range(BANDS)))
    rows = nodes.select("node", F.explode(bands).alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("first"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("who")).filter("members > 1")
    # buckets with the same members count once
    shared = shared.groupBy("members", "who", "first").agg(F.min("key").alias("key"))
    buckets = table(rows.join(shared.select("key", "first"), "key").select("key", "first", "node"))
    # sets of the nodes that share a bucket
    ids = nodes.select("node", "doc_id", "th").join(buckets.select("node").distinct(), "node", "left_semi")
    wanted = docs.select("doc_id", "text", F.xxhash64("text").alias("th")).join(ids, ["doc_id", "th"]).dropDuplicates(["doc_id", "th"])

    def as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            texts = [t.encode() if t else b"" for t in batch.column(1).to_pylist()]
            for i, j in chunks(texts, 2_000_000):
                s, n = shingle_sets(texts[i:j], words)
                ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                items = pa.ListArray.from_arrays(pa.array(ends), pa.array(s.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), items], ["node", "items"])

    sets = table(wanted.select("node", "text").mapInArrow(as_sets, "node bigint, items array<bigint>"))
    # first each node with the least of its buckets' centres, a pair a node; then, in the buckets that this leaves in
    # several components, with those centres that are not in its own
    least = buckets.filter("node != first").groupBy("node").agg(F.min("first").alias("a"))
    star = least.select("a", F.col("node").alias("b"), F.col("a").alias("ca"), F.col("node").alias("cb"))
    comp = components(_linked(_likely(star, nodes), sets, percent))
    at, mixed = _spread(buckets, comp)
    other = at.join(mixed, "key").filter("comp != centre").select(F.col("first").alias("a"), F.col("node").alias("b"), F.col("centre").alias("ca"), F.col("comp").alias("cb")).distinct()
    more = _linked(_likely(table(other), nodes), sets, percent).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    comp = components(comp.filter("node != component").select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    at, mixed = _spread(buckets, comp)
    open_ = table(at.join(mixed.select("key"), "key", "left_semi").select("node", "comp").distinct())
    # prefixes leave pairs that sketches would let through (98 of 100 of them), so these go straight to their sets
    new = _ties(open_, sets, percent)
    # an id with several texts ties their sets together
    several = named.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a != b").select("doc_id", "a")
    tied = named.join(table(several), "doc_id").select("a", F.col("node").alias("b"))
    ties = comp.filter("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    whole = components(ties.unionByName(new).unionByName(tied.filter("a != b")))
    least = nodes.select("node", "doc_id").join(whole, "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    whole = table(whole.join(table(least), "component").select("node", "component_id"))
    out = sketched.drop("regs", "th").join(whole, "node", "left")
    # a set that is linked with no other: its least id
    alone = nodes.select("node", F.col("doc_id").alias("own"))
    out = out.join(table(alone), "node", "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component_id", "own")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
