"""Helpers that the operators share: text access, shared tables, Arrow maps.

Common rules, which every operator of this subpackage follows:

* a null text counts as the empty text; a null ``doc_id`` is carried through;
* repeated rows are treated as separate documents with the same id;
* columns that an operator does not name are ignored, whatever they are called:
  each operator first projects its inputs onto private names;
* empty tables give empty results with the full schema.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes of one Arrow batch; bounds a Python worker's memory.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches; let workers import this package from where it lies."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where it is unset on one machine (tests) a temporary folder takes its place; a cluster must name one.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = os.environ.get("TICKLOOM_SHARED_DIR") or tempfile.mkdtemp(prefix="tickloom-")
        os.environ["TICKLOOM_SHARED_DIR"] = at
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(at)
    return at


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back: cuts the lineage."""
    return stored_at(df, name, compression)[0]


def stored_at(df: DataFrame, name: str, compression: str = "zstd") -> tuple[DataFrame, str]:
    """As ``stored``, and the table's path, for ``remove`` once nothing reads it any more."""
    spark = df.sparkSession
    at = shared_path(spark, name)
    df.write.option("compression", compression).parquet(at)
    return spark.read.schema(df.schema).parquet(at), at


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def split_of(doc_id: Column, mod: int) -> Column:
    """crc32 of the decimal id, modulo ``mod``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod, F.lit(-1)).cast("int")


def body(text: Column) -> Column:
    """Whole text as UTF-8 bytes; null is empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def mapped(df: DataFrame, schema: str | StructType, start: Callable[[], Callable[[pa.RecordBatch], list | None]]) -> DataFrame:
    """mapInArrow with per-task state: ``start()`` gives a function from a batch to columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            out = step(batch)
            if out is not None:
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(out, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def filtered(df: DataFrame, start: Callable[[], Callable[[list], list]], column: str = "text") -> DataFrame:
    """Rows of ``df`` that are kept, all columns as they are: ``start()`` gives a function from a batch's values of
    ``column`` to booleans. Rows are judged each by itself, where they lie; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(step(batch.column(batch.schema.get_field_index(column)).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def told_each(df: DataFrame, facts: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """``df`` joined with ``facts``, which has each ``key`` once, where one key may have a third of df's rows: the rows
    are split by a hash of ``by``, and each split of a key is told once."""
    n = 2 * max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    split = df.withColumn("_split", F.pmod(F.xxhash64(by), F.lit(n)))
    told = split.select(key, "_split").distinct().join(facts, key)
    return split.join(told, [key, "_split"], how).drop("_split")


def lower_words(raw: bytes) -> list[bytes]:
    """ASCII-lower-cased words between the ASCII white space 0x20 and 0x09-0x0D."""
    return raw.lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply, shift) over uint64, vectorised."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
