"""Questions and answers between groups of documents and buckets of keys.

Documents are dealt to groups by a hash of the whole row (so copies of a text, or a
busy source, spread evenly). A group asks about its *different* keys only,
packed into one row for each bucket; the bucket, which sees each key once for each group at most however
often it occurs, answers each group in one packed row; the group, joined with
its answers, goes on. Neither side ever holds all occurrences of a frequent key.
Everything is one lazy plan: a lost executor costs its own partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import common

#: Groups for each shuffle partition.
GROUPS = 2


def partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def dealt(docs: DataFrame, *more) -> DataFrame:
    """(g, doc_id, b, more of these): each row's group."""
    g = F.pmod(F.xxhash64("doc_id", "text"), F.lit(GROUPS * partitions(docs))).cast("int")
    return docs.select(g.alias("g"), F.col("doc_id").cast("long").alias("doc_id"), common.body(F.col("text")).alias("b"), *more)


def grouped(docs: DataFrame, *more) -> DataFrame:
    """(g, doc_id, b, more...), moved to partitions by g."""
    n = partitions(docs)
    return dealt(docs, *more).repartition(n, "g")


KINDS = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def arrow_schema(schema: str) -> pa.Schema:
    """Of a flat ``name type, ...`` list; workers have no session that could parse it."""
    return pa.schema([(name, KINDS[kind]) for name, kind in (x.split() for x in schema.split(", "))])


def table_of(schema: str, columns: list) -> pa.Table:
    """A table of columns; of no columns at all, an empty one."""
    arrow = arrow_schema(schema)
    columns = columns or [[]] * len(arrow)
    return pa.Table.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, arrow, strict=True)], schema=arrow)


def per_group(docs: DataFrame, schema: str, each: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """``each`` over the rows of every group."""
    return docs.groupBy("g").applyInArrow(each, schema)


def per_group_with(docs: DataFrame, answers: DataFrame, schema: str, each: Callable[[pa.Table, pa.Table], pa.Table]) -> DataFrame:
    """``each`` over the rows of every group and the answers it got."""
    return docs.groupBy("g").cogroup(answers.repartition(partitions(docs), "g").groupBy("g")).applyInArrow(each, schema)


def split(keys: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its keys in ascending key order)."""
    bucket = (keys >> np.uint64(33)) % np.uint64(n)
    order = np.lexsort((keys, bucket))
    edges = np.searchsorted(bucket[order], np.arange(n + 1))
    for k in range(n):
        if edges[k] < edges[k + 1]:
            yield k, order[edges[k] : edges[k + 1]]


def per_bucket(asked: DataFrame, schema: str, each: Callable[[list[dict]], Iterator[list]]) -> DataFrame:
    """``each`` over all the questions of one bucket; yields rows."""
    def run(key, table):
        return table_of(schema, list(zip(*each(table.to_pylist()), strict=True)))

    return asked.repartition(partitions(asked), "bucket").groupBy("bucket").applyInArrow(run, schema)
