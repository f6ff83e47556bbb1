"""Layered column plans: each layer's expressions may use the columns of the layers before.

On Spark every layer is one select; frames with the same partitioning and order share one shuffle
and sort (by symbol, ts), whatever their lengths. The oracle renders the same layers as a chain
of common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Layer = dict[str, str]


def apply(df: DataFrame, layers: list[Layer]) -> DataFrame:
    for layer in layers:
        df = df.select("*", *(F.expr(e).alias(name) for name, e in layer.items()))
    return df


def to_sql(base: str, layers: list[Layer]) -> str:
    """``base``: the body of the first CTE."""
    parts = [f"b0 AS ({base})"]
    for k, layer in enumerate(layers):
        parts.append(f"b{k + 1} AS (SELECT *, " + ", ".join(f'{e} AS "{name}"' for name, e in layer.items()) + f" FROM b{k})")
    return "WITH " + ", ".join(parts)


def chosen(columns: list[str], places: int = 6) -> list[str]:
    """Output expressions: keys as they are, values as rounded doubles."""
    return ["symbol", "ts", *(f"round(CAST({c} AS DOUBLE), {places}) AS {c}" for c in columns)]


def finish(df: DataFrame, columns: list[str], places: int = 6) -> DataFrame:
    return df.selectExpr(*chosen(columns, places))
