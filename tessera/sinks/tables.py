"""Writing tables and documents: partitioned Parquet, numbered issues, reports, manifests with immutable entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "errorifexists") -> None:
    """Parquet by partition columns, each task writing few partitions: rows are gathered by them and spread by a salt that
    Spark's adaptive splitting chooses."""
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def numbered(df: DataFrame, keys: list[str], order: list[str], prefix: str = "iss_", name: str = "issue_id") -> DataFrame:
    """Rows with ids ``iss_000001`` ... by order within their key."""
    return df.withColumn(name, F.format_string(f"{prefix}%06d", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))))


def documents(df: DataFrame, keys: list[str], order: list[str], name: str = "document") -> DataFrame:
    """A JSON document per key with its rows in order and their number."""
    own = [c for c in df.columns if c not in keys]
    ordered = F.array_sort(F.collect_list(F.struct(*order, F.struct(*own).alias("_t_row"))))
    out = df.groupBy(*keys).agg(ordered.alias("_t_rows"))
    return out.select(*keys, F.to_json(F.struct(*keys, F.size("_t_rows").alias("count"), F.transform("_t_rows", lambda r: r["_t_row"]).alias("items"))).alias(name))


def canonical_json(columns: list[str]) -> Column:
    """Columns as JSON with sorted keys, nulls kept: equal content has equal text."""
    return F.to_json(F.struct(*(F.col(c) for c in sorted(columns))), {"ignoreNullFields": "false"})


def content_hash(columns: list[str]) -> Column:
    return F.sha2(canonical_json(columns), 256)


def upsert_immutable(existing: DataFrame, new: DataFrame, key: str, content: str) -> DataFrame:
    """Entries after adding new ones: known keys keep their content; ``conflict`` marks those that came with another."""
    e = existing.select(key, F.col(content).alias("_t_old"))
    n = new.groupBy(key).agg(F.min(content).alias("_t_new"), F.count_distinct(content).alias("_t_n"))
    both = e.join(n, key, "full")
    conflict = (F.col("_t_old").isNotNull() & F.col("_t_new").isNotNull() & (F.col("_t_old") != F.col("_t_new"))) | (F.coalesce("_t_n", F.lit(1)) > 1)
    return both.select(key, F.coalesce("_t_old", "_t_new").alias(content), conflict.alias("conflict"))


def flat_lists(df: DataFrame) -> DataFrame:
    """Arrays as comma-separated text and maps as JSON, as text formats need them."""
    out = {}
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind == "array":
            out[f.name] = F.array_join(F.col(f.name).cast("array<string>"), ",")
        elif kind in ("map", "struct"):
            out[f.name] = F.to_json(F.col(f.name))
    return df.withColumns(out) if out else df
