"""Left join of many rows with a table of unique keys, whatever share of the rows one key holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialise

HOT = 10_000  # rows that ask for one key from which on the key counts as hot
BROADCAST = 100_000  # hot keys that are broadcast at most; there are never more than rows / HOT


def join_unique(rows: DataFrame, table: DataFrame, on: list[str], hot: int = HOT) -> DataFrame:
    """``rows`` with the columns of ``table``, in which each key occurs once; null where there is none.

    Keys that more than ``hot`` rows ask for are counted first and joined by broadcast, so their rows stay where they are;
    all others are shuffled. Should the hot keys be too many to broadcast, none holds a large share and skew-join
    splitting is enough.
    """
    asked = materialise(rows.groupBy(*on).count().filter(F.col("count") > hot).select(*on), "hot-keys")
    n = asked.count()
    if not 0 < n <= BROADCAST:
        return rows.join(table, on, "left")
    wanted = F.broadcast(materialise(table.join(F.broadcast(asked), on, "left_semi"), "hot-rows"))
    common = rows.join(F.broadcast(asked), on, "left_semi").join(wanted, on, "left")
    others = rows.join(F.broadcast(asked), on, "left_anti").join(table, on, "left")
    return others.unionByName(common)
