"""Latest row per key, top-k and key-ordered scans.

``latest_by_key`` is an aggregate (``max`` of a struct led by the ordering
columns), not a window: Spark combines map-side, so a key holding a third of
all rows is reduced inside every map task before the shuffle, and no task
ever sorts a whole hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Keep, per key, the row with the largest ``order`` tuple (ties: largest row)."""
    keys = list(keys)
    cols = [c for c in (columns or df.columns) if c not in keys]
    if all(isinstance(o, str) for o in order):
        # the same plan written as two SQL expressions: built with a handful of
        # driver-to-JVM calls instead of several per field (this runs per micro-batch)
        fields = [f"'__o{i}', {_name(o)}" for i, o in enumerate(order)] + [f"{_text(c)}, {_name(c)}" for c in cols]
        best = F.expr(f"max(named_struct({', '.join(fields)}))").alias("__best")
        return (df.groupBy(*keys).agg(best)
                .selectExpr(*[_name(k) for k in keys], *[f"__best.{_name(c)} AS {_name(c)}" for c in cols]))
    order_exprs = [(F.col(o) if isinstance(o, str) else o).alias(f"__o{i}") for i, o in enumerate(order)]
    best = F.max(F.struct(*order_exprs, *[F.col(c) for c in cols])).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in cols])


def _name(c: str) -> str:
    """A column name quoted as a SQL identifier."""
    return "`" + c.replace("`", "``") + "`"


def _text(c: str) -> str:
    """A column name as a SQL string literal."""
    return "'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'"


def top_k(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows in ``order`` (per-partition top-k, then a small merge)."""
    return df.orderBy(*order).limit(n)


def with_rank(df: DataFrame, order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """Top ``n`` rows with a 1-based rank; the rank window only sees those ``n`` rows."""
    from pyspark.sql.window import Window
    top = top_k(df, order, n)
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def key_ordered_scan(df: DataFrame, key: str, n: int | None) -> DataFrame:
    """First ``n`` rows in key order (a store scan with a row limit)."""
    ordered = df.orderBy(F.col(key))
    return ordered.limit(n) if n else ordered
