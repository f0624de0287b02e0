"""Word sequences of a corpus as arrays of numbers, in chunks.

Shared by the operators that count runs of words.  A chunk is a few documents'
words as numbers into the chunk's own list of words; it is written once, so its
number and its contents stay the same for every later stage.  What a chunk needs
to know about the whole corpus (a word's frequency or number) is asked and
answered by joins on its distinct words, so no task holds the vocabulary.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from spacetime.llm.common import shuffle_width, stored
from spacetime.session import checkpoint_dir

#: Tokens after which a task closes a chunk (at the end of a document).
CHUNK_TOKENS = 1 << 20
#: Stands between pieces; no UTF-8 text holds this byte.
BREAK = b"\xff"

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def packed(a: np.ndarray) -> bytes:
    """An array of tokens for a row: a reader holds many rows at a time."""
    return zlib.compress(a.tobytes(), 1)


def unpacked(b: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b), dtype=dtype)


class Numbers(dict):
    """Numbers words in the order in which they are asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Chunk:
    """Words as numbers; a break is -1."""

    def __init__(self) -> None:
        self.numbers = Numbers({BREAK: 0})
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int32, count=len(words)))
        self.size += len(words)

    def tokens(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, dtype=np.int32), *self.parts]) - np.int32(1)

    def words(self) -> list[str]:
        return [w.decode("utf-8") for w in self.numbers if w != BREAK]


def chunk_number(nth: int) -> int:
    """A number for the ``nth`` chunk of this task, the same if it runs again."""
    return (TaskContext.get().partitionId() << 32) | nth


def arrow_map(df: DataFrame, run: Callable[[dict], Iterator[tuple]], schema: str) -> DataFrame:
    """``run(row)`` yields the rows made of each row of ``df`` (a dict of plain
    values, arrays as numpy); those of one row are a batch, as chunks are large."""
    types = to_arrow_schema(StructType.fromDDL(schema))
    names = df.columns

    def value(x: pa.Scalar):
        if isinstance(x, pa.ListScalar) and x.is_valid and pa.types.is_primitive(x.type.value_type) and not x.values.null_count:
            return x.values.to_numpy(zero_copy_only=False)
        return x.as_py()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                made = list(run({n: value(batch.column(c)[i]) for c, n in enumerate(names)}))
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(zip(*made), types)], names=types.names)

    return df.mapInArrow(each, schema)


def by_chunk(df: DataFrame, name: str) -> DataFrame:
    """``df`` written in buckets of its column ``chunk``: joins on it read the
    buckets in place and shuffle nothing.  The table's name is dropped at once,
    its files stay where every executor reads them."""
    spark = df.sparkSession
    table, path = f"chunks_{uuid.uuid4().hex}", f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(shuffle_width(spark), "chunk").sortBy("chunk").saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def ranked(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``df`` stored with ``id``: its rows' places (from 0) in ``order`` within
    each ``group``.  The rows are sorted by ranges; a range's first place comes
    from the sizes of the ranges before it, so no task sees a whole group."""
    place, part = F.col("_at"), F.shiftright("_at", 33)
    rows = stored(df.orderBy(group, *order).withColumn("_at", F.monotonically_increasing_id()), name)
    ranges = rows.groupBy(group, part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = ranges.select(group, "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    return stored(rows.withColumn("_part", part).join(starts, [group, "_part"]).withColumn("id", place + F.col("_shift")).drop("_at", "_part", "_shift"), name)


def answers(asked: DataFrame, known: DataFrame, on: list[str], value: str) -> DataFrame:
    """``chunk, at, value``: for each chunk the places ``at`` of its words that
    ``known`` has, and their values, as two arrays.  ``asked`` has ``chunk, at``
    and the columns ``on``."""
    pairs = asked.join(known.select(*on, value), on)
    both = pairs.groupBy("chunk").agg(F.collect_list(F.struct("at", value)).alias("a"))
    return both.select("chunk", F.col("a.at").alias("at"), F.col(f"a.{value}").alias(value))
