"""Insert-or-update of bar tables, repeatable without effect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlework.schemas import ENRICHED, ENRICHED_KEYS, MAX_LENGTH, SUMMARY, SUMMARY_KEYS


def too_long(value: Column, field: T.StructField) -> Column:
    return F.length(value) > field.metadata[MAX_LENGTH]


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, with an error for a key that several rows have.

    As in SQL a key with a NULL part is equal to none. The rows are brought together
    by ``keys``, as a join on them needs anyway; rows that lie by some of the keys, such
    as those of the feature windows, stay where they are.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    message = F.concat(F.lit("several rows for "), F.to_json(F.struct(*keys)))
    several = whole & (F.col("_n") > 1)
    one = F.when(several, F.raise_error(message).cast("boolean")).otherwise(True)
    counted = df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return counted.where(one).drop("_n")


def declared_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types, and nothing checked.

    A column that has its type already is left as it is, so rows that lie by the keys
    are known to do so still.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def conform_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types.

    A value that does not fit its type or is longer than declared is an error, and
    so is NULL in a column declared without.
    """

    def column(field: T.StructField):
        value = F.col(field.name).cast(field.dataType)
        if MAX_LENGTH in field.metadata:
            bad = F.raise_error(F.lit(f"{field.name} is too long")).cast(field.dataType)
            value = F.when(too_long(value, field), bad).otherwise(value)
        if not field.nullable:
            message = F.lit(f"{field.name} is missing")
            missing = F.raise_error(message).cast(field.dataType)
            value = F.when(value.isNull(), missing).otherwise(value)
        return value.alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def merge_upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """``existing`` after inserting or updating the rows of ``incoming``.

    Where a key is on both sides, ``update_cols`` (default: all non-key columns)
    take the incoming value, also when that is NULL, and the rest stay as they
    are. A key that several incoming rows have is an error: use ``dedup_keep_last``
    on them first.
    """
    return merge_unique(existing, unique_rows(incoming, keys), keys, update_cols)


def merge_unique(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """``merge_upsert`` of incoming rows that are known to be unique on ``keys``."""
    others = [c for c in existing.columns if c not in keys]
    updates = set(others if update_cols is None else update_cols)
    # Presence is told by a marker: any data column may be NULL.
    old = existing.withColumn("_stored", F.lit(True)).alias("old")
    new = incoming.select(*existing.columns).withColumn("_arrived", F.lit(True)).alias("new")
    joined = old.join(new, list(keys), "full_outer")

    def pick(c: str):
        stored, arrived = F.col(f"old.{c}"), F.col(f"new.{c}")
        if c in updates:
            return F.when(F.col("_arrived"), arrived).otherwise(stored).alias(c)
        return F.when(F.col("_stored"), stored).otherwise(arrived).alias(c)

    merged = [F.col(c) if c in keys else pick(c) for c in existing.columns]
    return joined.select(*merged)


def constraint_violations(enriched: DataFrame, summary: DataFrame) -> DataFrame:
    """``constraint_name, n_violations`` of the declared NOT NULL, length and UNIQUE rules."""

    def per_key(df: DataFrame, keys: list[str], schema: T.StructType, table: str):
        not_null = [f.name for f in schema.fields if not f.nullable]
        limited = [f for f in schema.fields if MAX_LENGTH in f.metadata]
        # One shuffle serves both kinds of rule: nulls are counted per key first.
        grouped = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in not_null],
            *[F.count_if(too_long(F.col(f.name), f)).alias(f"_long_{f.name}") for f in limited],
        )
        # A key with a NULL part is not a duplicate, as in SQL's UNIQUE.
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        counts = grouped.agg(
            *[
                F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(f"{table}.{c} not null")
                for c in not_null
            ],
            *[
                F.coalesce(F.sum(f"_long_{f.name}"), F.lit(0)).alias(f"{table}.{f.name} length")
                for f in limited
            ],
            F.count_if(whole & (F.col("_n") > 1)).alias(
                f"{table}.({','.join(keys)}) unique"
            ),
        )
        names = counts.columns
        return counts.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(n).alias("constraint_name"),
                            F.col(f"`{n}`").alias("n_violations"),
                        )
                        for n in names
                    ]
                )
            )
        )

    return per_key(enriched, ENRICHED_KEYS, ENRICHED, "enriched_stocks").unionByName(
        per_key(summary, SUMMARY_KEYS, SUMMARY, "ticker_summary")
    )
