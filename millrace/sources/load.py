"""Raw CSV files in, clean tables and a load summary out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from millrace.sources.schemas import PRODUCTS, RAW_TABLES, TRANSLATION, TableSpec

# file order: the file, the block of it that a task reads, then the row within
_FILE, _BLOCK, _ROW = "_load_file", "_load_block", "_load_row"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Header row, quoted text, optional BOM. Nothing is inferred; a timestamp
    that cannot be parsed becomes NULL, not an error. Only ``multi_line`` allows
    line breaks inside quotes; without it a large file is split over tasks."""
    times = {f.name for f in schema if isinstance(f.dataType, T.TimestampNTZType)}
    as_text = T.StructType([T.StructField(f.name, T.StringType() if f.name in times else f.dataType) for f in schema])
    raw = (
        spark.read.schema(as_text)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    return raw.withColumns({name: F.expr(f"try_cast(`{name}` AS timestamp_ntz)") for name in sorted(times)})


def with_file_order(df: DataFrame) -> DataFrame:
    place = {_FILE: "_metadata.file_path", _BLOCK: "_metadata.file_block_start"}
    return df.withColumns({**{k: F.col(v) for k, v in place.items()}, _ROW: F.monotonically_increasing_id()})


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``. An aggregate rather than a
    window: each task keeps one row per key, so a key that fills a third of the
    table never meets in one task."""
    others = [c for c in df.columns if c not in key]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("_first")
    return df.groupBy(*key).agg(first).select(*key, "_first.*").select(*df.columns)


def clean_table(df: DataFrame, spec: TableSpec, order: Sequence[str]) -> DataFrame:
    """Rows with a NULL key dropped, the first row per key kept."""
    if spec.key:
        df = df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in spec.key]))
        return keep_first(df, spec.key, order)
    if spec.distinct_on:
        return keep_first(df, spec.distinct_on, order)
    return df


def translate_categories(products: DataFrame, translation: DataFrame | None) -> DataFrame:
    """English category by left join; the original name only when there is no
    translation table at all. The table is small, but Spark checks its size."""
    if translation is None:
        return products.withColumn("product_category_name_english", F.col("product_category_name"))
    return products.join(
        translation.select("product_category_name", "product_category_name_english"), "product_category_name", "left"
    )


def load_table(
    spark: SparkSession, path: str, spec: TableSpec, translation: DataFrame | None = None
) -> tuple[DataFrame | None, DataFrame]:
    """A clean table and its one-row status (table, loaded, status)."""
    if not path_exists(spark, path):
        return None, _status(spark, spec.name, 0, "MISSING")
    ordered = with_file_order(read_csv(spark, path, spec.schema, spec.multi_line))
    table = clean_table(ordered, spec, [_FILE, _BLOCK, _ROW]).drop(_FILE, _BLOCK, _ROW)
    if spec.name == PRODUCTS.name:
        table = translate_categories(table, translation)
    status = table.agg(F.count("*").alias("loaded")).select(
        F.lit(spec.name).alias("table"), "loaded", F.lit("OK").alias("status")
    )
    return table, status


def _status(spark: SparkSession, table: str, loaded: int, status: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(table).alias("table"), F.lit(loaded).cast("bigint").alias("loaded"), F.lit(status).alias("status")
    )


def load_all(
    spark: SparkSession,
    folder: str,
    target: str | None = None,
    files: dict[str, str] | None = None,
    load_id: str | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """All raw tables of a folder, and the load summary.

    With ``target`` each table is appended there as Parquet and read back; a
    load named by ``load_id`` replaces itself when it is run again. Rows are
    counted while they are written (or, without a target, read through once),
    so a table that fails is reported as ERROR and the others go on."""
    tables: dict[str, DataFrame] = {}
    statuses: list[DataFrame] = []
    for spec in RAW_TABLES:
        path = f"{folder}/{(files or {}).get(spec.name, spec.name + '.csv')}"
        try:
            table, status = load_table(spark, path, spec, tables.get(TRANSLATION.name))
            if table is not None:
                seen = Observation()
                counted = table.observe(seen, F.count(F.lit(1)).alias("loaded"))
                if target is None:
                    counted.write.format("noop").mode("overwrite").save()
                else:
                    append_table(counted, f"{target}/{spec.name}", _month_column(table), load_id)
                    table = spark.read.parquet(f"{target}/{spec.name}")
                status = _status(spark, spec.name, seen.get["loaded"], "OK")
        except Exception:  # noqa: BLE001 - one bad file must not stop the load
            table, status = None, _status(spark, spec.name, 0, "ERROR")
        if table is not None:
            tables[spec.name] = table
        statuses.append(status)
    return tables, load_summary(statuses)


def _month_column(table: DataFrame) -> str | None:
    return "order_purchase_timestamp" if "order_purchase_timestamp" in table.columns else None


def load_summary(statuses: Sequence[DataFrame]) -> DataFrame:
    """Status rows of the tables plus a total row."""
    rows = reduce(DataFrame.unionByName, statuses)
    total = rows.agg(F.sum("loaded").alias("loaded")).select(
        F.lit("TOTAL").alias("table"), "loaded", F.lit("").alias("status")
    )
    return rows.unionByName(total)


def append_table(df: DataFrame, path: str, month_of: str | None = None, load_id: str | None = None) -> None:
    """Append as Parquet, by load where it is named and by purchase month where
    there is one. A named load that is written again takes its own place. The
    rebalance hint evens out file sizes and lets AQE split a hot month."""
    folders = []
    if month_of is not None:
        df = df.withColumn("purchase_month", F.date_format(month_of, "yyyy-MM")).hint("rebalance", "purchase_month")
        folders.append("purchase_month")
    if load_id is None:
        df.write.mode("append").partitionBy(*folders).parquet(path)
    else:  # the whole load is replaced, months it no longer has included
        df.write.mode("overwrite").partitionBy(*folders).parquet(f"{path}/load_id={load_id}")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    partitions: int = 64,
    **options: str,
) -> DataFrame:
    """A database table, read in parallel ranges when a column is named."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", partitions)
        )
    return reader.load()


def append_jdbc(df: DataFrame, url: str, table: str, batch: int = 10_000, **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch).options(
        **options
    ).mode("append").save()


def catalogue(tables: dict[str, DataFrame]) -> DataFrame:
    """Name and row count of every table."""
    counts = [
        df.agg(F.count("*").alias("table_rows")).select(F.lit(name).alias("table_name"), "table_rows")
        for name, df in sorted(tables.items())
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")
