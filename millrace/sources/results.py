"""Feature tables, result files and the selection document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.sources.schemas import SELECTION_DOCUMENT


def write_features(df: DataFrame, path: str) -> None:
    """Feature rows keep their date, so nothing has to be matched by position."""
    df.write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def require_columns(df: DataFrame, required: Sequence[str], source: str) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{source} lacks column(s) {missing}; found {df.columns}")
    return df


def read_selection(spark: SparkSession, path: str) -> DataFrame:
    """The nested selection document as one row per category."""
    return flatten_selection(read_json(spark, path, SELECTION_DOCUMENT, multi_line=True))


def flatten_selection(document: DataFrame) -> DataFrame:
    return document.select("global_default_model", F.explode("per_category").alias("category", "choice")).select(
        "category",
        F.col("choice.selected_model").alias("selected_model"),
        F.col("choice.confidence").alias("confidence"),
        F.col("choice.reason").alias("reason"),
        F.col("choice.mapes")["baseline"].alias("baseline_mape"),
        F.col("choice.mapes")["lstm"].alias("lstm_mape"),
        F.col("choice.mapes")["gbm"].alias("gbm_mape"),
        "global_default_model",
    )


def read_keyed_json(spark: SparkSession, path: str, value: str, key: str = "category") -> DataFrame:
    """A file holding one object per key (``{"a": {...}, "b": {...}}``) as rows."""
    text = spark.read.option("wholetext", True).text(path)
    parsed = F.from_json("value", f"map<string, struct<{value}>>")
    return text.select(F.explode(parsed).alias(key, "_v")).select(key, "_v.*")


def latest_snapshot(features: DataFrame, key: str = "category", date: str = "sale_date") -> DataFrame:
    """The newest cached feature row per key, for use when the live tables are
    away. An aggregate, so no key needs all its rows in one task."""
    others = [c for c in features.columns if c != key]
    return features.groupBy(key).agg(F.max_by(F.struct(*others), date).alias("_row")).select(key, "_row.*")
