"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from spacetime.session import checkpoint_dir

# Fixed value: what separates words in every contract of this subpackage.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table of a data folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: lineage ends here and every later reader sees the same rows, also
    after executors are lost."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A command run inside drops what it shuffled as soon as it ends; without
    this the files stay until the driver happens to collect garbage.  For steps
    that are stored: nothing reads their shuffles again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def map_batches(df: DataFrame, make: Callable[[pa.RecordBatch], list[pa.Array | list]], schema: str, rows: int = 1000) -> DataFrame:
    """Rows made from Arrow batches of at most ``rows`` rows.  ``make`` gives one
    column per field of ``schema``; columns it hands through keep their exact
    values, nulls included."""
    types = to_arrow_schema(StructType.fromDDL(schema))
    names = types.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                made = make(batch.slice(i, rows))
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, types.field(n).type) for n, c in zip(names, made)], names=names)

    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``df.mapInArrow(run)`` with the columns of ``df``; ``run`` sees them by
    position, so any column name will do."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)


def shuffle_width(spark: SparkSession) -> int:
    """The session's shuffle partitions (its own measure of the data size)."""
    try:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    except ValueError:
        return max(1, spark.sparkContext.defaultParallelism)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of ``df`` by name, whatever the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def words_of(text: Column) -> Column:
    """The words of a text as an array; null text has none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def bounded_broadcast(small: DataFrame, max_rows: int) -> DataFrame:
    """``small`` (already stored) marked for broadcast if it has at most
    ``max_rows`` narrow rows; otherwise as it is, for a shuffled join."""
    return F.broadcast(small) if small.limit(max_rows + 1).count() <= max_rows else small
