"""One-permutation MinHash fingerprints with optimal densification and b-bit packing, in DataFrame operations.

A shingle's 64-bit hash names its bin (the top bits) and its value there. An empty bin takes the value of the first
non-empty bin of its own probe sequence, which all documents share; if the first PROBES are empty too, of the
non-empty bin with the smallest hash of the pair, which is the same choice from a random order of all bins. What is
taken over is hashed with the empty bin's number, so that chance matches of low bits stay independent.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS, BITS, PROBES, SHINGLE = 256, 4, 8, 5
_LOW = (1 << 56) - 1
_ONES = int("1" * 16, 16)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value worked out once a row although lambdas inside use it often."""
    return F.transform(F.array(value), then)[0]


def _shingles(text: Column) -> Column:
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def of(h: Column) -> Column:
        n = F.size(h)
        many = F.transform(F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*(h[i + k] for k in range(SHINGLE))))
        return F.when(n >= SHINGLE, many).when(n > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of)


def packed_minhash(text: Column) -> Column:
    """array<bigint> of BINS * BITS bits; null for a text without words."""
    drawn = random.Random(BINS)
    probes = _numbers([drawn.randrange(BINS) for _ in range(BINS * PROBES)], "int")
    ends = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.shiftleft(b.cast("bigint"), 56).bitwiseOR(F.lit(_LOW)))

    def firsts(s: Column) -> Column:  # of sorted hashes, an end mark in every bin: the least of each bin
        return F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, 56) != F.shiftright(s[F.greatest(i - 1, F.lit(0))], 56)))

    def dense(full: Column) -> Column:
        def filled(i: Column) -> Column:
            near = F.filter(F.slice(probes, i * PROBES + 1, F.lit(PROBES)), lambda p: full[p].isNotNull())
            bins = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda p: full[p].isNotNull())
            far = F.array_min(F.transform(bins, lambda p: F.struct(F.xxhash64(i, p + 1000).alias("h"), p.alias("p"))))["p"]
            return _let(near, lambda c: F.when(F.size(c) > 0, F.xxhash64(full[F.get(c, F.lit(0))], i)).otherwise(F.xxhash64(full[far], i)))

        return F.transform(full, lambda x, i: F.when(x.isNotNull(), x).otherwise(filled(i)))

    def pack(v: Column) -> Column:
        per = 64 // BITS
        low = F.lit((1 << BITS) - 1).cast("bigint")
        return F.transform(
            F.sequence(F.lit(0), F.lit(BINS // per - 1)),
            lambda k: F.aggregate(F.slice(v, k * per + 1, per), F.lit(0).cast("bigint"), lambda a, x: F.shiftleft(a, BITS).bitwiseOR(x.bitwiseAND(low))),
        )

    def of(h: Column) -> Column:
        least = _let(F.sort_array(F.concat(h, ends)), firsts)
        full = F.transform(least, lambda x: F.when(x.bitwiseAND(F.lit(_LOW)) != F.lit(_LOW), x))
        return F.when(F.size(h) > 0, _let(_let(full, dense), pack))

    return _let(_shingles(text), of)


def as_text(packed: Column) -> Column:
    """Hex digits; the empty string for a text without words."""
    return F.coalesce(F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity in 0..1: the share of equal bins, less what low-order bits match by chance.
    Two texts without words are alike, one of them is unlike any other."""

    def unequal(x: Column) -> Column:
        y = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        y = y.bitwiseOR(F.shiftrightunsigned(y, 2)).bitwiseAND(F.lit(_ONES))
        return F.bit_count(y).cast("bigint")

    differ = F.aggregate(F.zip_with(a, b, lambda x, y: _let(x.bitwiseXOR(y), unequal)), F.lit(0).cast("bigint"), lambda s, x: s + x)
    chance = 2.0**-BITS
    share = ((1 - differ / BINS) - chance) / (1 - chance)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), share)))


def _cuts(docs: DataFrame, rows_per_bucket: int, buckets: int, bucket_bytes: int) -> tuple[list[int], set[int], int, list[int]]:
    """Ascending ids that cut docs into ranges of about rows_per_bucket rows (at most `buckets` of them), the ranges
    (k: from cuts[k - 1] on, -1: null ids) that hold a single id with more rows than that, in how many cells each range
    is to be split so that a cell has about bucket_bytes of text, however large docs are, and the ends of the ranges."""
    size = F.sum(F.octet_length("text").cast("bigint") + 64)
    n, with_id, volume, least, most = docs.agg(F.count("*"), F.count("doc_id"), size, F.min("doc_id"), F.max("doc_id")).first()
    ranges = min(buckets, -(-n // rows_per_bucket))
    split = -(-(volume or 0) // (buckets * bucket_bytes)) or 1
    heavy = {-1} if (n - with_id) * ranges > n else set()
    if ranges < 2 or not with_id:
        return [], heavy, split, []
    found = docs.agg(F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)], max(10_000, 8 * ranges))).first()[0]
    often = {a for a, b in zip(found, found[1:]) if a == b}
    cuts = sorted({*found, *(a + 1 for a in often if a < (1 << 63) - 1)})
    return cuts, heavy | {cuts.index(a) + 1 for a in often}, split, [least, *cuts, most]


def _numbers(values: list[int], kind: str) -> Column:
    """A literal array, whatever its length."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def with_next(docs: DataFrame, columns: list[str], rows_per_bucket: int = 4096, buckets: int = 8192, bucket_bytes: int = 1 << 27) -> DataFrame:
    """docs (doc_id, text, ...) with next_<c> of the next row in descending doc_id, the first one's after the last.

    Approximate quantiles cut the ids into at most `buckets` ranges; an id with more rows than a range has one of its
    own, dealt by the rows' text hashes. Where a range would hold more than bucket_bytes of text, it is split into
    cells of equal width between its two ends, so cells grow in number with the corpus. Cells, in order, make buckets,
    and each bucket is sorted on its own; its head also stands, as a ghost, at the end of the one before. Which ids are
    cut where changes no result. Null ids come last; rows of one id are in the order of their text, or, where they
    outnumber a range, of a hash of it. Only rows equal in both can't be dealt."""
    cuts, heavy, split, ends = _cuts(docs, rows_per_bucket, buckets, bucket_bytes)
    cell = F.lit(0)
    if cuts:
        ids, steps = _numbers(cuts, "bigint"), [1 << k for k in reversed(range(len(cuts).bit_length()))]
        cell = F.aggregate(_numbers(steps, "int"), F.lit(0), lambda c, k: F.when(F.get(ids, c + k - 1) <= F.col("doc_id"), c + k).otherwise(c))
        if split > 1:  # doubles keep the ids' order, and ids that they merge stay in one cell
            borders = _numbers(ends, "double")

            def within(k: Column) -> Column:
                low, high = borders[k], borders[k + 1]
                turn = F.when(high > low, F.floor((F.col("doc_id").cast("double") - low) / (high - low) * split)).otherwise(0)
                return k.cast("bigint") * split + F.greatest(F.lit(0), F.least(F.lit(split - 1), turn))

            cell = _let(cell, within)
    cell = F.when(F.col("doc_id").isNull(), -1).otherwise(cell)
    tie = F.lit(0).cast("bigint")
    if heavy:
        tie = F.when(F.col("_cell").isin(*(k if k < 0 else k * split for k in heavy)), F.shiftrightunsigned(F.xxhash64("text"), 1)).otherwise(tie)
    placed = docs.withColumn("_cell", cell).withColumn("_tie", tie).withColumn("_part", F.shiftright("_tie", 57).cast("int"))
    turn = (F.desc("_cell"), F.asc("_part"))
    # a row a cell, or 64 for a heavy one, whatever the corpus
    counted = placed.groupBy("_cell", "_part").agg(F.count("*").alias("_n"), F.min(F.struct(F.bitwise_not("doc_id").alias("i"), F.col("_tie").alias("t"))).alias("_least"))
    before = F.sum("_n").over(Window.orderBy(*turn)) - F.col("_n")
    each = F.greatest(F.lit(rows_per_bucket), F.ceil(F.sum("_n").over(Window.partitionBy(F.lit(0))) / (buckets * split)))
    counted = counted.withColumn("_b", F.floor(before / each))
    counted = counted.withColumn("_bucket", F.dense_rank().over(Window.orderBy("_b")))
    counted = counted.withColumn("_rank", F.row_number().over(Window.partitionBy("_bucket").orderBy(*turn))).withColumn("_last", F.max("_bucket").over(Window.partitionBy(F.lit(0))))
    counted = counted.select(
        "_cell", "_part", "_bucket", F.when(F.col("_rank") == 1, F.struct("_least")).alias("_head"),
        F.when(F.col("_bucket") == 1, F.col("_last")).otherwise(F.col("_bucket") - 1).alias("_before"),
    )
    placed = placed.join(F.broadcast(counted), ["_cell", "_part"])
    least = F.col("_head._least")
    is_head = F.col("_head").isNotNull() & F.bitwise_not("doc_id").eqNullSafe(least["i"]) & (F.col("_tie") == least["t"])
    own, ghost = F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("g")), F.struct(F.col("_before").alias("b"), F.lit(True).alias("g"))
    placed = placed.withColumn("_at", F.explode(F.when(is_head, F.array(own, ghost)).otherwise(F.array(own)))).withColumns({"_b": F.col("_at.b"), "_g": F.col("_at.g")})
    order = Window.partitionBy("_b").orderBy("_g", F.col("doc_id").desc_nulls_last(), "_tie", F.col("text").asc_nulls_first())
    out = placed.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return out.filter(~F.col("_g")).select(*docs.columns, *(f"next_{c}" for c in columns))


def edited_text(text: Column, following: Column) -> Column:
    """text with its last floor(n / 3) code points replaced by the first as many (or all) of the following text."""
    n = F.char_length(text)
    m = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - m), F.substring(following, F.lit(1), m))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document with its own, its edited text's and its likeness to the next document's fingerprint.

    A null text is empty; texts without words have the empty fingerprint; a text of fewer than SHINGLE words is one
    shingle. Repeated rows, null ids and a table of one row (its own next) are defined in with_next."""
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("packed", packed_minhash(F.col("text")))
    near = with_next(own, ["text", "packed"]).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    near = near.withColumn("packed_edited", packed_minhash(F.col("edited")))
    return near.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        as_text(F.col("packed")).alias("fingerprint"), as_text(F.col("packed_edited")).alias("edited_fingerprint"),
        likeness(F.col("packed"), F.col("packed_edited")).alias("near_edited"), likeness(F.col("packed"), F.col("next_packed")).alias("near_next"),
    )
