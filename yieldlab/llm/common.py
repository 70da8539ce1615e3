"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

__all__ = ["HashCache", "drop_table", "materialize", "partitions", "remainder", "small_batches", "table", "text_rows"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Hand texts to Python tasks in batches of at most ``most`` bytes; a
    smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > most:
        spark.conf.set(key, str(most))


def partitions(spark: SparkSession) -> int:
    """The session's shuffle parallelism."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)


def remainder(id_col: str, n: int = 5) -> Column:
    """crc32 of the id's decimal text modulo ``n`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: computed
    once, and no executor that is lost later takes it along."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_table(spark: SparkSession, df: DataFrame) -> None:
    """Delete the folder behind a DataFrame made by ``materialize``, once
    nothing that is still to run reads it."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for f in {p.rpartition("/")[0] for p in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(conf).delete(path, True)


def text_rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, a few thousand rows as Python objects
    at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield from zip(*(part.column(part.schema.get_field_index(n)).to_pylist() for n in names))


class HashCache(dict):
    """Word bytes -> 64-bit hash, remembered; forgets all when it gets large,
    so that memory is bounded whatever the vocabulary."""

    def __init__(self, most: int = 200_000, seed: int = 0):
        super().__init__()
        import xxhash

        self.most, self.seed, self.hash = most, seed, xxhash.xxh64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.hash(word, self.seed)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
