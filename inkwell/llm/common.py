"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the word pattern of every contract (anything but space and the ASCII controls 9 to 13).
WORD = r"[^\x20\x09-\x0D]+"

_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 1 << 64)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; where the session names none, a temporary one in local mode, an
    error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", "")
    if not named:
        held = spark.sparkContext.getCheckpointDir()
        if not held:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="inkwell-ckpt-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut, through the cluster's checkpoint folder; Spark removes the files with the last
    reference to them."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def table(df: DataFrame) -> DataFrame:
    """df written as a table in the shared folder and read again. Loops use this: a checkpointed plan keeps the
    constraints that the optimiser inferred, and over many rounds they fill the driver."""
    path = f"{shared_folder(df.sparkSession)}/inkwell-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_ids(schema: str) -> str:
    """A schema whose doc_id is text. pandas holds longs beside nulls as doubles, which are exact up to 2**53 only, so ids
    go through pandas as decimal text and come back by long_ids."""
    return schema.replace("doc_id bigint", "doc_id string", 1)


def with_text_ids(docs: DataFrame, *others) -> DataFrame:
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), *others)


def long_ids(df: DataFrame) -> DataFrame:
    return df.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def crc_fold(col: str = "doc_id"):
    """crc32 of the id as text, modulo 5; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % 5


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Random-looking 64-bit value of each byte.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """M**i and M**-i modulo 2**64 for i < n; short ones are kept."""
    if "p" in _powers and n <= len(_powers["p"]):
        return _powers["p"][:n], _powers["q"][:n]
    size = 1 << max(16, (n - 1).bit_length())
    made = []
    for base in (_MULT, _INV):
        x = np.full(size, base, np.uint64)
        x[0] = 1
        made.append(np.multiply.accumulate(x))
    if size <= 1 << 21:
        _powers["p"], _powers["q"] = made
    return made[0][:n], made[1][:n]


class Rolling:
    """Prefix sums of a symbol array, from which the hash of any slice comes in O(1)."""

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        p, self.inverse = powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * p[:n], out=self.sums[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        m = max(0, len(self.sums) - k)
        return mix((self.sums[k:] - self.sums[:m]) * self.inverse[:m]) if m else np.zeros(0, np.uint64)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def words_of(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of many texts at once: (hash of each word, its text's index, its first byte, its end) with bytes
    counted from the start of its own text."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1] if len(texts) else np.zeros(0, np.int64)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    value = Rolling(BYTE_VALUE[data]).slices(start, end)
    text = np.searchsorted(begins, start, side="right") - 1
    return value, text, start - begins[text], end - begins[text]


def chunks(texts: list, size: int = 4_000_000):
    """Index ranges of texts, each of about size bytes (one text at least)."""
    first = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield first, i
            first, total = i, 0
        total += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


_held: dict[str, object] = {}


def held(name: str, make):
    """The one large object that a Python worker keeps from task to task; asking for another one lets go of it."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def let_go() -> None:
    """Forget it, and hand freed memory back to the system: called by operators that need the room."""
    _held.clear()
    give_back()


def give_back() -> None:
    """Hand freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
