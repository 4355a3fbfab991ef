"""Data-quality operators (Q1-Q5). All return DataFrames; the raising helpers act on
one-row aggregates only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_count(df: DataFrame, keys) -> DataFrame:
    """Q1: rows minus distinct keys (0 when the key is unique), one row."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(*[F.col(k) for k in keys])).alias("duplicate_rows"))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Q1: the duplicated keys with their multiplicity (a partial aggregate)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique(df: DataFrame, keys, what: str = "table") -> None:
    """Abort before writing when a key repeats (the training-set rule)."""
    dup = duplicate_count(df, keys).first()["duplicate_rows"]
    if dup:
        raise ValueError(f"{what} contains {dup:,} duplicate {tuple(keys)} rows; aborting write")


def null_counts(df: DataFrame) -> DataFrame:
    """A14 core: one pass, one row per column (column_name, null_count, n_rows)."""
    names = df.columns
    aggs = [F.count(F.lit(1)).alias("__n")] + [
        F.count_if(F.col(f"`{c}`").isNull()).alias(f"__c{i}") for i, c in enumerate(names)
    ]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', __c{i}" for i, c in enumerate(names))
    return one.selectExpr(f"stack({len(names)}, {stack}) as (column_name, null_count)", "__n as n_rows")


def high_null_columns(df: DataFrame, threshold: float = 0.40) -> DataFrame:
    """Q2: columns whose null rate is strictly above ``threshold``."""
    nc = null_counts(df)
    rate = F.col("null_count") / F.col("n_rows")
    return nc.where(rate > threshold).select(
        "column_name", "null_count", F.round(rate, 6).alias("null_rate"))


def unique_report(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Q3: per table, rows, distinct keys and whether the key is unique."""
    out = None
    for name, (df, keys) in tables.items():
        r = df.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.count_distinct(*[F.col(k) for k in keys]).alias("n_keys")).select(
            F.lit(name).alias("table_name"), "n_rows", "n_keys",
            (F.col("n_rows") == F.col("n_keys")).alias("ok"))
        out = r if out is None else out.unionByName(r)
    return out


def orphans(child: DataFrame, parent: DataFrame, child_keys, parent_keys=None, name: str = "fk") -> DataFrame:
    """Q4: child rows whose non-null key has no parent row (anti-join), counted."""
    parent_keys = parent_keys or child_keys
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(parent_keys, child_keys)]).distinct()
    c = child.where(F.lit(True) if not child_keys else
                    F.expr(" and ".join(f"`{k}` is not null" for k in child_keys)))
    return c.join(p, child_keys, "left_anti").agg(F.count(F.lit(1)).alias("orphans")).select(
        F.lit(name).alias("fk"), "orphans")


def with_errors(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Q5: add ``errors array<string>``: the names of the rules a row breaks.

    A rule is a boolean column that is true when the row is valid; null counts as broken. The optimizer puts
    the expression behind a rule in its place, so nothing here may be a higher-order function: these are interpreted, and so
    is all that stands in their arguments.
    """
    none = F.array().cast("array<string>")
    checks = [F.when(F.coalesce(cond, F.lit(False)), none).otherwise(F.array(F.lit(name))) for name, cond in rules.items()]
    return df.withColumn("errors", F.flatten(F.array(*checks)))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Q5: (good rows without the errors column, quarantined rows with it)."""
    marked = with_errors(df, rules)
    good = marked.where(F.size("errors") == 0).drop("errors")
    bad = marked.where(F.size("errors") > 0)
    return good, bad
