"""Data-quality report: row floors, NULLs, duplicate keys, orphans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def dq_report(
    tables: dict[str, DataFrame],
    floors: dict[str, int] | None = None,
    keys: dict[str, Sequence[str]] | None = None,
    references: Sequence[tuple[str, str, str, str]] = (),
    not_null: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Rows (table, check, column, value, passed).

    ``references`` holds (child table, child column, parent table, parent
    column). Row and NULL counts of a table come from one scan."""
    parts: list[DataFrame] = []
    for name in sorted(set(floors or {}) | {t for t, _ in not_null}):
        parts.append(_scan_checks(tables[name], name, (floors or {}).get(name), [c for t, c in not_null if t == name]))
    for name, key in (keys or {}).items():
        parts.append(_unique_key(tables[name], name, key))
    for child, column, parent, parent_column in references:
        parts.append(_orphans(tables[child], child, column, tables[parent], parent_column))
    return reduce(DataFrame.unionByName, parts)


def _row(table: str, check: str, column: str, value: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        value.cast("bigint").alias("value"),
        passed.alias("passed"),
    )


def _scan_checks(df: DataFrame, table: str, floor: int | None, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in columns])
    rows = [_row(table, "row_floor", "", F.col("_rows"), F.col("_rows") >= floor)] if floor is not None else []
    rows += [_row(table, "not_null", c, F.col(f"_null_{c}"), F.col(f"_null_{c}") == 0) for c in columns]
    return counts.select(F.inline(F.array(*rows)))


def _unique_key(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    repeated = df.groupBy(*key).agg(F.count("*").alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("_keys"))
    return repeated.select(F.inline(F.array(_row(table, "unique_key", ",".join(key), F.col("_keys"), F.col("_keys") == 0))))


def _orphans(child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose value the parent lacks. The child is counted per value
    first, so a value held by a third of the rows joins as one row."""
    values = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_fk")).agg(F.count("*").alias("_n"))
    known = parent.select(F.col(parent_column).alias("_fk"))
    lost = values.join(known, "_fk", "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"))
    return lost.select(F.inline(F.array(_row(table, "foreign_key", column, F.col("_rows"), F.col("_rows") == 0))))
