"""Data-quality checks that return their findings as DataFrames.

Each check is a small aggregate plan (one row per table or per check), so it
runs as one distributed job and only a handful of rows ever reach the driver
(in ``enforce``).  Checks never fail by themselves; ``enforce`` raises once,
after every failing row has been collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import ident, sql_lit


class DataQualityError(RuntimeError):
    pass


def _union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_counts(tables: Mapping[str, DataFrame], label: str = "table_name") -> DataFrame:
    """``(table_name, row_count)`` for every table, as one union of global aggregates."""
    return _union_all(
        [df.agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(F.lit(n).alias(label), "row_count")
         for n, df in tables.items()]
    )


def min_rows(tables: Mapping[str, DataFrame], minimums: Mapping[str, int]) -> DataFrame:
    """V1: ``(table_name, min_rows, actual_rows, passed)``; passes when actual >= min."""
    report = _union_all(
        [
            tables[n]
            .agg(F.count(F.lit(1)).cast("long").alias("actual_rows"))
            .select(F.lit(n).alias("table_name"), F.lit(int(m)).cast("long").alias("min_rows"), "actual_rows")
            for n, m in minimums.items()
        ]
    )
    return report.withColumn("passed", F.col("actual_rows") >= F.col("min_rows"))


def non_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """V2: ``(table_name, row_count, passed)``; an empty table fails."""
    return row_counts(tables).withColumn("passed", F.col("row_count") > 0)


def grain_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """V3: one row, ``duplicate_groups`` = number of key groups with more than one row.

    Two aggregates, both pre-aggregated map-side: a hot key is a single partial
    count per task before the shuffle.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.count_if(F.col("_n") > 1).cast("long").alias("duplicate_groups"))


def null_counts(df: DataFrame, columns: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """V4/V5: one row, one BIGINT column per checked column (NULL on empty input)."""
    names = list(names or columns)
    return df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(n) for c, n in zip(columns, names)])


def key_uniqueness(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """K5: ``(table_name, rows, distinct_keys)`` - equal when the key is unique."""
    return _union_all(
        [df.agg(F.count(F.lit(1)).cast("long").alias("rows"), F.count_distinct(key).cast("long").alias("distinct_keys"))
         .select(F.lit(n).alias("table_name"), "rows", "distinct_keys")
         for n, (df, key) in tables.items()]
    )


def profile_stats(column: str, digits: int = 6) -> dict[str, Column]:
    """The statistics of one column as aggregates, by name."""
    x, d = ident(column), int(digits)
    return {
        "count": F.expr(f"CAST(count({x}) AS BIGINT)"),
        "mean": F.expr(f"round(CAST(avg({x}) AS DOUBLE), {d})"),
        "stddev": F.expr(f"round(stddev_samp(CAST({x} AS DOUBLE)), {d})"),
        "min": F.expr(f"CAST(min({x}) AS DOUBLE)"),
        "max": F.expr(f"CAST(max({x}) AS DOUBLE)"),
    }


def profile(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """V6: typed ``describe()`` in long form: ``(measure, count, mean, stddev, min, max)``.

    All statistics of all columns come from one aggregate (one pass, partial
    aggregation), then are unpivoted.  ``stddev`` is the sample deviation;
    mean and stddev are rounded to ``digits``.
    """
    aggs = [column.alias(f"c{i}_{stat}") for i, c in enumerate(columns) for stat, column in profile_stats(c, digits).items()]
    wide = df.agg(*aggs)
    stats = ("count", "mean", "stddev", "min", "max")
    rows = ", ".join(
        f"named_struct('measure', {sql_lit(c)}, " + ", ".join(f"'{s}', c{i}_{s}" for s in stats) + ")"
        for i, c in enumerate(columns)
    )
    return wide.selectExpr(f"inline(array({rows}))")


def content_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """An aggregate over the rows of ``df`` that depends on their values but not on their order: the sum
    of the first 40 bits of each row's MD5, modulo 2^63 (a BIGINT sum is full after some 16 million
    rows).  NULL is written ``~``, a double as a whole number of ten-thousandths, everything else as text;
    columns in the order of their names."""
    parts = []
    for c in sorted(columns or df.columns):
        whole = "CAST(round({0} * 10000) AS BIGINT)" if df.schema[c].dataType.simpleString() == "double" else "{0}"
        parts.append(f"coalesce(CAST({whole.format(ident(c))} AS STRING), '~')")
    bits = f"CAST(conv(substr(md5(concat_ws('|', {', '.join(parts)})), 1, 10), 16, 10) AS DECIMAL(28,0))"
    return F.expr(f"CAST(pmod(sum({bits}), {1 << 63}) AS BIGINT)")


def enforce(report: DataFrame, what: str = "data quality") -> None:
    """Raise once if any row of a check report has ``passed = false``.

    Reports are one row per table/check, so collecting the failures is bounded.
    """
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        details = "; ".join(", ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in failed)
        raise DataQualityError(f"{what} failed: {details}")


def referential_integrity(
    checks: Mapping[str, tuple[DataFrame, str, DataFrame, str]],
) -> DataFrame:
    """Orphan report: ``(check_name, checked_rows, orphan_rows, passed)``.

    Each check is ``(child, child_key, parent, parent_key)``; a child row with a
    non-NULL key that matches no parent key is an orphan (NULL keys are not
    checked).  Child keys are counted per key first (partial aggregation: a hot
    key is one row per task before it moves), parent keys are distinct, and the
    left join that marks orphans runs on key counts, not rows.
    """
    parts = []
    for name, (child, ckey, parent, pkey) in checks.items():
        per_key = child.filter(F.col(ckey).isNotNull()).groupBy(F.col(ckey).alias("_k")).agg(
            F.count(F.lit(1)).alias("_n"))
        parents = parent.select(F.col(pkey).alias("_k")).distinct().withColumn("_p", F.lit(True))
        report = per_key.join(parents, "_k", "left").agg(
            F.sum("_n").alias("_c"), F.sum(F.when(F.col("_p").isNull(), F.col("_n")).otherwise(0)).alias("_o")
        )
        parts.append(
            report.select(
                F.lit(name).alias("check_name"),
                F.coalesce(F.col("_c"), F.lit(0)).cast("long").alias("checked_rows"),
                F.coalesce(F.col("_o"), F.lit(0)).cast("long").alias("orphan_rows"),
            )
        )
    return _union_all(parts).withColumn("passed", F.col("orphan_rows") == 0)


def type_consistency(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """``(column_name, expected_type, non_null_values, unparsable_values)`` for text
    columns checked against the type they are expected to hold: a value is
    unparsable when it is not NULL but ``try_cast`` to the type gives NULL.
    One aggregate pass over all columns."""
    aggs = []
    for i, (c, t) in enumerate(expected.items()):
        x = ident(c)
        aggs += [
            f"CAST(count({x}) AS BIGINT) AS n{i}",
            f"CAST(count_if({x} IS NOT NULL AND try_cast({x} AS {t}) IS NULL) AS BIGINT) AS u{i}",
        ]
    wide = df.agg(*[F.expr(a) for a in aggs])
    rows = ", ".join(
        f"named_struct('column_name', {sql_lit(c)}, 'expected_type', {sql_lit(t)}, "
        f"'non_null_values', n{i}, 'unparsable_values', u{i})"
        for i, (c, t) in enumerate(expected.items())
    )
    return wide.selectExpr(f"inline(array({rows}))")
