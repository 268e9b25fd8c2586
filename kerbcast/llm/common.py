"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbcast.session import fresh_path

#: Rows handled together inside a task; bounds what one step holds, whatever the batch size of Arrow is.
ROWS_AT_ONCE = 256


def texts_of(docs: DataFrame, *others: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and the named columns only, so that no other column can clash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *[F.col(f"`{c}`") for c in others],
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and independent of any executor."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sized(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of the column (or one longer text)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy())
        part = ends // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for at, stop in zip(cuts, cuts[1:]):
            yield batch.slice(at, stop - at)


def ascii_words(text: str) -> list[bytes]:
    """Maximal runs without space, tab, line feed, vertical tab, form feed and carriage return; A-Z in lower
    case. Both methods of ``bytes`` know ASCII only, which is the rule wanted here."""
    return text.encode("utf-8", "replace").lower().split()


def hashed_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit number per word of all texts, one after another, and the number of words of each text."""
    lists = [ascii_words(t) for t in texts]
    counts = np.array([len(x) for x in lists], dtype=np.int64)
    flat = np.empty(int(counts.sum()), dtype=object)
    flat[:] = [w for x in lists for w in x]
    if not len(flat):
        return np.empty(0, dtype=np.uint64), counts
    codes, values = pd.factorize(flat)
    return pd.util.hash_array(values, categorize=False)[codes], counts


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads every bit (multiplications and shifts)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
