"""Shared helpers: reading tables, cutting lineage, hashing words inside tasks."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir

#: white space of the word definition: space, tab, newline, vertical tab, form feed, carriage return
WORD_GAP = r"[\x20\x09-\x0D]+"
ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"  # rows that a Python worker gets at once
_LETTERS = re.compile(r"[^\W\d_]+")
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


@contextmanager
def settings_during(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside a ``with`` block; what was set before holds again after it."""
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


class Stage:
    """Intermediate tables of one run, written to the shared folder and read back.

    A written table cuts the lineage, survives the loss of any executor and is
    never tied to one machine (the folder is ``spark.checkpoint.dir``).
    """

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/souk-llm/{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def write(self, df: DataFrame, name: str, rows_per_batch: int | None = None) -> DataFrame:
        """``rows_per_batch``: rows that a Python worker gets at once during this write (whole texts are large).

        The shuffle files of the write are removed when it ends, not when the driver happens to collect garbage:
        every read is of the written table."""
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        during = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
        if rows_per_batch:
            during[ROWS_PER_BATCH] = str(rows_per_batch)
        with settings_during(self.spark, during):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the 64 output bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def odd_constants(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers derived from a seed."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


class WordHasher(dict):
    """word (bytes) -> 64-bit hash; remembers at most ``limit`` words."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ascii_words(text: str | None) -> list[bytes]:
    """Words between runs of ASCII white space, A-Z lower-cased (other letters kept as they are)."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def letter_words(text: str | None) -> list[str]:
    """Runs of letters, lower-cased: the words of the text classifiers."""
    return [] if text is None else _LETTERS.findall(text.lower())
