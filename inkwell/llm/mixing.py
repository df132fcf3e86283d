"""Sainte-Laguë apportionment of equal-token blocks to sources, then to the shards of each source.

DataFrame operations only. The seats are found in closed form but for at most two candidates a party: with
quotients votes / (seat + 1/2), every seat of round(votes * (seats - parties / 2) / total) is certain, none beyond
round(votes * (seats + parties / 2) / total) is possible, and only those between are ranked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut


def apportion(parties: DataFrame, seats: str, votes: str, keys: list[str], within: list[str]) -> DataFrame:
    """parties with a column quota: column `seats` (the same in all rows of a `within` group) shared by the highest
    quotients votes / (s + 1/2), s = 0, 1, ...; ties go to the smaller keys, nulls last. No votes, no seats."""
    w = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    n, total = F.count(F.when(F.col(votes) > 0, 1)).over(w), F.sum(votes).over(w)
    ratio = F.col(votes) / total

    def rounded(shift):
        return F.when((F.col(votes) > 0) & (total > 0), F.floor(F.greatest(F.col(seats) + shift, F.lit(0.0)) * ratio + 0.5)).otherwise(0).cast("bigint")

    # one seat of slack on either side against rounding of doubles
    held = parties.withColumns({"_sure": F.greatest(rounded(-n / 2) - 1, F.lit(0)), "_most": F.when(F.col(votes) > 0, rounded(n / 2) + 1).otherwise(0)})
    rest = held.withColumn("_rest", F.col(seats) - F.sum("_sure").over(w))
    bids = rest.filter("_most > _sure").select(
        *keys, *(c for c in within if c not in keys), "_rest", votes, F.explode(F.sequence("_sure", F.col("_most") - 1)).alias("_seat")
    )
    order = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    order = order.orderBy((F.col(votes) / (F.col("_seat") + 0.5)).desc(), *(F.col(k).asc_nulls_last() for k in keys), "_seat")
    won = bids.withColumn("_rank", F.row_number().over(order)).filter("_rank <= _rest")
    won = won.groupBy(*(F.col(k).alias(f"_key_{k}") for k in keys)).agg(F.count("*").alias("_won"))
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return rest.join(won, same, "left").select(*parties.columns, (F.col("_sure") + F.coalesce("_won", F.lit(0))).alias("quota"))


def targets(sources: DataFrame, cap: float = 3.0) -> DataFrame:
    """(source, source_size, weight, target): weights 1, 2, 3 repeating by code point, null last, of 100 % of all
    sizes; what a cap of `cap` times the source's size cuts off goes to the others by weight, until none is above.

    Water filling: with sources in ascending cap / weight, the capped ones are a prefix, the longest in which each
    cap is below the level that the rest would reach."""
    # one row a source: windows over the whole small table
    named = sources.withColumn("weight", (1 + (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3).cast("double"))
    up = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(0))
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(whole) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    leveled = named.withColumn("_level", level).withColumn("_capped", F.col("_level") > cap * F.col("source_size") / F.col("weight"))
    # the level that holds is that of the first source that isn't capped
    final = leveled.withColumn("_final", F.first(F.when(~F.col("_capped"), F.col("_level")), ignorenulls=True).over(up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(cap * F.col("source_size"), F.col("weight") * F.coalesce(F.col("_final"), F.lit(0.0)))
    return final.select("source", "source_size", "weight", target.alias("target"))


def _small(df: DataFrame, rows: int = 300_000) -> DataFrame:
    """df, broadcast if it has few rows (counted: it has been written) and left to a shuffle if not."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def mix_sources(docs: DataFrame, block: int = 16, shard_words: int = 200_000, shards: int = 4096, cap: float = 3.0, seed: int = 7, carry: str | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, epochs, part, taken, and the column `carry`.

    A source's target is `epochs` whole passes over it and a rest. The rests are divided into blocks of `block`
    words, apportioned to the sources, and each source's blocks to its shards (documents by seeded hash, about
    shard_words words each, at most `shards` a source). In a shard documents lie end to end in the order of a seeded
    draw and its quota of blocks is taken from the start, up to one draw at which it ends; `part` is how many of a
    document's first words are taken so. Only draws and sizes are shuffled: a document learns its shard's last draw
    from a small table, so what is carried stays where it was read.

    A null or empty text has size 0 and nothing is taken; a null source is a source of its own; repeated rows are
    documents of their own, and those on which a quota ends share what is left of it evenly, rounded down. An empty
    table gives an empty result."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    digest = F.sha2(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))), 256)
    digit = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint")
    own = [carry] if carry else []
    rows = docs.select("doc_id", "source", size.alias("size"), digit(1).alias("_draw"), digit(16).alias("_deal"), *own)
    rows = rows if carry else cut(rows)  # what is carried may be whole texts: counted again rather than written
    goal = cut(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), cap))
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.least(F.lit(int(cap)), F.floor(F.col("target") / F.col("source_size") + 1e-9))).otherwise(0).cast("bigint"))
    goal = goal.withColumn("_votes", F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0)))
    goal = goal.withColumn("_seats", F.round(F.sum("_votes").over(Window.partitionBy(F.lit(0))) / block))
    quotas = apportion(goal, "_seats", "_votes", ["source"], []).withColumnRenamed("quota", "_quota").drop("_votes", "_seats")
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    quotas = cut(quotas.withColumns({"_shards": F.least(F.lit(shards), F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))), "_key": key}))
    dealt = rows.withColumn("_key", key).drop("source").join(_small(quotas), "_key").withColumn("_shard", F.pmod("_deal", "_shards"))
    draws = cut(dealt.groupBy("_key", "_shard", "_draw").agg(F.sum("size").alias("_size"), F.count("*").alias("_rows"), F.first("_quota").alias("_seats")))
    parts = draws.groupBy("_key", "_shard").agg(F.sum("_size").alias("_votes"), F.first("_seats").alias("_seats"))
    parts = apportion(parts, "_seats", "_votes", ["_key", "_shard"], ["_key"]).select("_key", "_shard", (F.col("quota") * block).alias("_words"))
    stream = Window.partitionBy("_key", "_shard").orderBy("_draw").rowsBetween(Window.unboundedPreceding, 0)
    laid = draws.withColumn("_end", F.sum("_size").over(stream)).join(parts, ["_key", "_shard"]).filter("_end > _words")
    last = laid.groupBy("_key", "_shard").agg(F.min(F.struct("_draw", ((F.col("_words") - F.col("_end") + F.col("_size")) / F.col("_rows")).alias("each"))).alias("_last"))
    joined = dealt.join(_small(cut(last)), ["_key", "_shard"], "left")
    rest = F.when(F.col("_draw") == F.col("_last._draw"), F.least("size", F.floor("_last.each"))).otherwise(0)
    part = F.when(F.col("_last").isNull() | (F.col("_draw") < F.col("_last._draw")), F.col("size")).otherwise(rest)
    return joined.select("doc_id", "source", "size", "source_size", "target", "epochs", part.cast("bigint").alias("part"), *own).withColumn(
        "taken", F.col("epochs") * F.col("size") + F.col("part")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of docs: each document as often as its source's target asks for, the last
    time perhaps only its first words (the white space between them kept, n_chars counted anew). Documents of which
    nothing is taken are not in the result; options as in mix_sources."""
    mixed = mix_sources(docs.select("doc_id", "source", "text", F.struct("*").alias("_row")), carry="_row", **options)
    copies = F.concat(F.array_repeat(F.lit(-1).cast("bigint"), F.col("epochs").cast("int")), F.when(F.col("part") > 0, F.array("part")).otherwise(F.array().cast("array<bigint>")))
    rows = mixed.filter("taken > 0").select("_row", F.explode(copies).alias("_words"))
    # words with the white space before them
    words = F.split(F.col("_row.text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    text = F.when(F.col("_words") < 0, F.col("_row.text")).otherwise(F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("_words"), F.lit(0)).cast("int")), ""))
    rows = rows.withColumn("_text", text)
    new = {"text": F.col("_text"), "n_chars": F.char_length("_text").cast("bigint")}
    return rows.select(*(new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns))
