"""Data checks. Each returns the rows that break its rule; a passing check returns none.

Checks over many equal rows return each distinct row once with its count (`n_rows`), so a value
that fills a third of a table is counted before the shuffle and nothing is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.times import AsOf, as_of_column, shift
from tillstream.operators.joins import group_counts, unmatched_keys
from tillstream.operators.ordered import with_neighbour
from tillstream.operators.reshape import filtered_columns, symmetric_except


# ---- single-column rules -------------------------------------------------------------------


def unique(df: DataFrame, column: str) -> DataFrame:
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
    return counted.agg(F.count("*").alias("n_records")).where(F.col("n_records") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their counts; NULL passes."""
    counted = df.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))
    return counted.where(~F.col("value_field").isin(list(values)))


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values))).select(F.col(column).alias("value_field")).distinct()


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """Rows outside the range; NULL passes."""
    c, broken = F.col(column), F.lit(False)
    if min_value is not None:
        low = F.expr(min_value) if isinstance(min_value, str) else F.lit(min_value)
        broken = broken | ((c < low) if inclusive else (c <= low))
    if max_value is not None:
        high = F.expr(max_value) if isinstance(max_value, str) else F.lit(max_value)
        broken = broken | ((c > high) if inclusive else (c >= high))
    return df.where(broken)


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    """Rows whose text is empty (after trimming); NULL passes."""
    text = F.trim(F.col(column)) if trim_whitespace else F.col(column)
    return df.where(text == "")


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows where the SQL expression is false; NULL passes. With a column it is put in front."""
    text = f"{column} {expression}" if column else expression
    return df.where(~F.expr(f"({text})"))


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows where two columns differ; NULL passes."""
    return df.where(F.col(actual) != F.col(expected))


# ---- group rules ---------------------------------------------------------------------------


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the table) without any non-null value. The table form stops at the first one."""
    if group_by:
        counted = df.groupBy(*group_by).agg(F.count(column).alias("n_values"))
    else:
        counted = df.where(F.col(column).isNotNull()).select(column).limit(1).agg(F.count(column).alias("n_values"))
    return counted.where(F.col("n_values") == 0)


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups (or the table) with exactly one distinct value; all NULL passes.

    Smallest equals largest says the same as a distinct count of one and needs no shuffle by value.
    """
    low_high = df.groupBy(*group_by).agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    return low_high.where(F.col("_low") == F.col("_high")).select(*group_by, F.lit(1).alias("n_values"))


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    share = F.count(column) / F.nullif(F.count("*"), F.lit(0))
    shares = df.groupBy(*group_by).agg(share.alias("not_null_proportion"))
    return shares.where(~F.col("not_null_proportion").between(at_least, at_most))


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    as_of: AsOf,
    ignore_time_component: bool = False,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Groups (or the table) whose latest value is older than `interval` date parts before `as_of`."""
    kind = "date" if ignore_time_component else "timestamp_ntz"
    threshold = shift(as_of_column(as_of), datepart, -interval).cast(kind)
    latest = df.groupBy(*group_by).agg(F.max(field).cast(kind).alias("most_recent"))
    return latest.where(F.col("most_recent") < threshold).withColumn("threshold", threshold)


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column combinations that occur more than once, with counts; NULLs compare equal."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_records")).where(F.col("n_records") > 1)


# ---- rules over two tables -----------------------------------------------------------------


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """(value, count) pairs found on one side only. Both sides are counted in one grouped pass."""
    left = df.select(F.col(column).alias("value"), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    right = to.select(F.col(field).alias("value"), F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    counts = left.unionAll(right).groupBy("value").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    sides = F.array(
        F.struct(F.lit("a_minus_b").alias("which_diff"), F.col("_a").alias("num_rows")),
        F.struct(F.lit("b_minus_a").alias("which_diff"), F.col("_b").alias("num_rows")),
    )
    pairs = counts.where(F.col("_a") != F.col("_b")).select("value", F.explode(sides).alias("side"))
    return pairs.select("side.which_diff", "value", "side.num_rows").where(F.col("num_rows") > 0)


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Groups whose row counts differ. A group on one side only passes unless `strict`."""
    counts = group_counts(df, compare, group_by)
    difference = F.abs(F.col("count_a") - F.col("count_b"))
    if strict:
        difference = F.coalesce(difference, "count_a", "count_b")
    return counts.withColumn("diff_count", difference).where(F.col("diff_count") > 0)


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups with as many rows as the other side (delta 1) or more (delta = surplus)."""
    a, b = F.col("count_a"), F.col("count_b")
    delta = F.when(a > b, a - b).when(a == b, 1).otherwise(0)
    return group_counts(df, compare, group_by).withColumn("row_count_delta", delta).where(F.col("row_count_delta") > 0)


def equality(
    df: DataFrame,
    compare: DataFrame,
    compare_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    precision: int | None = None,
) -> DataFrame:
    """Distinct rows on one side only, on all columns or a chosen set, numbers rounded on request."""
    if compare_columns and exclude_columns:
        raise ValueError("give compare_columns or exclude_columns, not both")
    if compare_columns:
        columns = list(compare_columns)
    else:
        columns = filtered_columns(df, exclude_columns or ())
        others = filtered_columns(compare, exclude_columns or ())
        if {c.lower() for c in columns} != {c.lower() for c in others}:
            raise ValueError(f"column sets differ: {columns} and {others}")
    return symmetric_except(df, compare, columns, precision)


def equality_failures() -> Column:
    """Fail value of `equality`: the rows plus the imbalance between the sides."""
    sign = F.when(F.col("which_diff") == "a_minus_b", 1).otherwise(-1)
    return F.count("*") + F.coalesce(F.abs(F.sum(sign)), F.lit(0))


def relationships_where(
    df: DataFrame, column: str, to: DataFrame, field: str, from_condition: str = "true", to_condition: str = "true"
) -> DataFrame:
    """Non-null keys (with counts) that have no match on the other side, each side pre-filtered."""
    return unmatched_keys(df, to, column, field, from_condition, to_condition)


# ---- rules over row order ------------------------------------------------------------------

_GAP_RULES = {
    "allowed": lambda upper, lower: upper <= lower,
    "not_allowed": lambda upper, lower: upper == lower,
    "required": lambda upper, lower: upper < lower,
}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str | Column,
    upper: str | Column,
    partition_by: Sequence[str] = (),
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Ranges that are empty, have a NULL bound, or break the gap rule towards the next range.

    Equal ranges are counted first: all copies but the last have their own lower bound as the next
    one. Ranges without a lower bound sort last, always fail and are nobody's neighbour.
    """
    if gaps not in _GAP_RULES:
        raise ValueError(f"gaps must be one of {tuple(_GAP_RULES)}, got {gaps!r}")
    as_column = lambda c: F.expr(c) if isinstance(c, str) else c
    keys = list(partition_by)
    bounds = df.select(*keys, as_column(lower).alias("lower_bound"), as_column(upper).alias("upper_bound"))
    counted = bounds.groupBy(*keys, "lower_bound", "upper_bound").agg(F.count("*").alias("n_rows"))
    order = [*keys, "lower_bound", "_no_upper", "upper_bound"]
    rows = counted.where(F.col("lower_bound").isNotNull()).withColumn("_no_upper", F.col("upper_bound").isNull())
    rows = with_neighbour(rows, order, 1, "_next", within=keys, slices=slices)

    after = F.col("_next.lower_bound")
    last = F.when(after == F.col("lower_bound"), 0).otherwise(1).cast("bigint")
    copies = F.array(
        F.struct(F.col("lower_bound").alias("next"), (F.col("n_rows") - last).alias("n")),
        F.struct(after.alias("next"), last.alias("n")),
    )
    rows = rows.select(*keys, "lower_bound", "upper_bound", F.explode(copies).alias("c")).where("c.n > 0")
    low, high, following = F.col("lower_bound"), F.col("upper_bound"), F.col("c.next")
    proper = F.coalesce((low <= high) if zero_length_range_allowed else (low < high), F.lit(False))
    apart = F.when(following.isNull(), True).otherwise(F.coalesce(_GAP_RULES[gaps](high, following), F.lit(False)))
    broken = rows.where(~(proper & apart)).select(
        *keys, "lower_bound", "upper_bound", following.alias("next_lower_bound"), F.col("c.n").alias("n_rows")
    )
    unbounded = counted.where(F.col("lower_bound").isNull())
    missing = F.lit(None).cast(rows.schema["lower_bound"].dataType).alias("next_lower_bound")
    return broken.unionAll(unbounded.select(*keys, "lower_bound", "upper_bound", missing, "n_rows"))


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Values that are not the previous value plus the interval; the first of a group passes.

    Equal values are counted first: every copy after the first has the value itself before it.
    """
    keys = list(group_by)
    counted = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("n_rows"))
    order = [*keys, column]
    rows = with_neighbour(counted, order, -1, "_prev", within=keys, slices=slices)
    copies = F.array(
        F.struct(F.col("_prev").getField(column).alias("previous"), F.lit(1).cast("bigint").alias("n")),
        F.struct(F.col(column).alias("previous"), (F.col("n_rows") - 1).alias("n")),
    )
    rows = rows.select(*keys, column, F.explode(copies).alias("c")).where("c.n > 0 and c.previous is not null")
    previous = F.col("c.previous")
    expected = shift(previous, datepart, interval) if datepart else previous + interval
    return rows.where(F.col(column) != expected).select(
        *keys, column, previous.alias(f"previous_{column}"), F.col("c.n").alias("n_rows")
    )


# ---- rules over the schema -----------------------------------------------------------------


def columns_match_set(df: DataFrame, column_list: Sequence[str], transform=str.upper) -> DataFrame:
    """Names on one side only: (relation_column, input_column) with NULL for the missing one."""
    have, want = ({transform(c) for c in names} for names in (df.columns, column_list))
    rows = [(c, None) for c in sorted(have - want)] + [(None, c) for c in sorted(want - have)]
    return df.sparkSession.createDataFrame(rows, "relation_column string, input_column string")


# ---- running a set of checks ---------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A named rule and when it counts as a warning or an error.

    `rows` holds the failing rows; `fail_value` reduces them to one number. Without it, rows are counted;
    groups of failing rows with `n_rows` count as that many. A `where` filter on
    the tested table belongs into the call that builds `rows` (see `filtered`).
    """

    name: str
    rows: DataFrame
    fail_value: Column | None = None
    warn_if: str = "!= 0"
    error_if: str = "!= 0"

    def result(self) -> DataFrame:
        counted = F.sum("n_rows") if "n_rows" in self.rows.columns else F.count("*")
        value = counted if self.fail_value is None else self.fail_value
        failures = self.rows.agg(F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint")).alias("failures"))
        status = (
            F.when(F.expr(f"failures {self.error_if}"), "fail")
            .when(F.expr(f"failures {self.warn_if}"), "warn")
            .otherwise("pass")
        )
        return failures.select(F.lit(self.name).alias("check_name"), "failures", status.alias("status"))

    def store_failures(self, path: str) -> None:
        self.rows.write.mode("overwrite").parquet(path)


def not_null_results(model: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Result rows `not_null_<model>_<column>` for many columns from one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"not_null_{model}_{c}") for c in columns])
    rows = counted.unpivot([], counted.columns, "check_name", "failures")
    return rows.withColumn("status", F.when(F.col("failures") > 0, "fail").otherwise("pass"))


def filtered(df: DataFrame, where: str | None) -> DataFrame:
    return df if where is None else df.where(where)


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """One result row per check."""
    return reduce(DataFrame.unionAll, [c.result() for c in checks])


def failing(results: DataFrame) -> DataFrame:
    """What an alert should name; empty when all checks pass."""
    return results.where(F.col("status") == "fail")
