"""Column selection, pivots, unions, series and calendar spines."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.times import as_of_column, check_datepart


#: longest list of values taken to the driver, as in Spark's own pivot
MAX_VALUES = 10_000


def _lower(names: Sequence[str]) -> set[str]:
    return {n.lower() for n in names}


def filtered_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    left_out = _lower(exclude)
    return [c for c in df.columns if c.lower() not in left_out]


def star(
    df: DataFrame, exclude: Sequence[str] = (), prefix: str = "", suffix: str = "", alias: str | None = None
) -> list[Column]:
    """All columns but `exclude` (case ignored), optionally read through a join alias and renamed."""
    source = (lambda c: F.col(f"{alias}.`{c}`")) if alias else (lambda c: F.col(f"`{c}`"))
    return [source(c).alias(f"{prefix}{c}{suffix}") for c in filtered_columns(df, exclude)]


def nullcheck(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Empty strings become NULL; columns of other types pass through."""
    wanted = df.columns if columns is None else columns
    return [
        F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c)
        if isinstance(df.schema[c].dataType, T.StringType)
        else F.col(f"`{c}`")
        for c in wanted
    ]


def nullcheck_table(df: DataFrame) -> DataFrame:
    return df.select(*nullcheck(df))


def group_by_first(df: DataFrame, n: int):
    """Group by the first `n` columns."""
    return df.groupBy(*df.columns[:n])


def slugify(name: str) -> str:
    """Column-safe name: `2nd Half-Year!` gives `_2nd_half_year`."""
    slug = re.sub(r"[^a-z0-9_]", "", re.sub(r"[ -]+", "_", name.lower()))
    return re.sub(r"^(?=[0-9])", "_", slug)


_COMPARE = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
}
_AGGREGATES = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}
_DISTINCT_AGGREGATES = {"sum": F.sum_distinct, "count": F.count_distinct, "min": F.min, "max": F.max}


def _value(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def pivot_columns(
    column: str | Column,
    values: Sequence,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    quote_identifiers: bool = True,
    distinct: bool = False,
    alias: bool = True,
) -> list[Column]:
    """One conditional aggregate per value, for `groupBy(...).agg(*pivot_columns(...))`.

    All cells come from one pass; a value that does not occur gives `else_value`, not NULL.
    """
    aggregates = _DISTINCT_AGGREGATES if distinct else _AGGREGATES
    if agg not in aggregates or cmp not in _COMPARE:
        raise ValueError(f"unsupported aggregate {agg!r} or comparison {cmp!r}")
    subject = F.col(column) if isinstance(column, str) else column
    out = []
    for v in values:
        cell = F.when(_COMPARE[cmp](subject, v), _value(then_value)).otherwise(_value(else_value))
        measure = aggregates[agg](cell)
        name = f"{prefix}{v}{suffix}"
        out.append(measure.alias(name if quote_identifiers else slugify(name)) if alias else measure)
    return out


def pivot(
    df: DataFrame, group_by: Sequence[str], column: str, values: Sequence | None = None, most: int = MAX_VALUES, **options
) -> DataFrame:
    """`pivot_columns` grouped; without `values` they are looked up (most frequent first), `most` of them
    or an error."""
    if values is None:
        values = bounded_values(column_values(df, column), most)
    return df.groupBy(*group_by).agg(*pivot_columns(column, values, **options))


def column_values(
    df: DataFrame,
    column: str,
    order_by: Sequence[Column] | None = None,
    max_records: int | None = None,
    where: str | Column | None = None,
) -> DataFrame:
    """Distinct values of a column, most frequent first (ties by value), with their counts."""
    rows = df if where is None else df.where(where)
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_rows"))
    ordered = counted.orderBy(*(order_by or [F.col("n_rows").desc(), F.col("value").asc_nulls_first()]))
    return ordered if max_records is None else ordered.limit(max_records)


def bounded_values(values: DataFrame, most: int = MAX_VALUES) -> list:
    """First column as a list; more than `most` values is an error, not a cut."""
    found = [r[0] for r in values.limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} values; use the DataFrame itself")
    return found


def table_column_values(
    spark: SparkSession, table: str, column: str, default=None, most: int = MAX_VALUES, **options
) -> list:
    """`column_values` of a catalog table as a list; `default` if the table is missing or empty."""
    if not spark.catalog.tableExists(table):
        if default is None:
            raise ValueError(f"table {table} does not exist and no default was given")
        return default
    return bounded_values(column_values(spark.table(table), column, **options), most) or default


def single_value(df: DataFrame, default=None):
    """First column of the first row."""
    row = df.first()
    return default if row is None else row[0]


def results_as_dict(df: DataFrame, max_rows: int = MAX_VALUES) -> dict[str, tuple]:
    """Columns as tuples, for small lookup results; a larger result is an error, not a cut."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; use the DataFrame itself")
    return {name: tuple(r[i] for r in rows) for i, name in enumerate(df.columns)}


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to (field, value) rows in one scan. `exclude` columns are kept beside the pair,
    `remove` columns are dropped, NULL values stay."""
    keep = [c for c in df.columns if c.lower() in _lower(exclude)]
    fields = [c for c in filtered_columns(df, (*exclude, *remove))]
    typed = df.select(*keep, *[F.col(f"`{c}`").cast(cast_to).alias(c) for c in fields])
    return typed.unpivot(keep, fields, field_name, value_name)


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = "source_relation",
    where: str | None = None,
) -> DataFrame:
    """UNION ALL over the columns of all inputs in first-seen order, missing ones as NULL.

    A column takes the type it has where it is first seen, the widest if it is a sized string, or
    the one named in `column_override`.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    wanted, unwanted = _lower(include), _lower(exclude)
    types: dict[str, T.DataType | str] = {}
    for df in relations.values():
        for field in df.schema:
            name = field.name
            if name.lower() in unwanted or (include and name.lower() not in wanted):
                continue
            if name not in types or _wider_text(field.dataType, types[name]):
                types[name] = field.dataType
    if not types:
        raise ValueError(f"no columns to union for {list(relations)}")
    types.update({c: t for c, t in (column_override or {}).items() if c in types})

    parts = []
    for source, df in relations.items():
        rows = df if where is None else df.where(where)
        tag = [F.lit(source).alias(source_column_name)] if source_column_name else []
        cells = [(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
        parts.append(rows.select(*tag, *cells))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def _wider_text(new: T.DataType, old) -> bool:
    sized = (T.CharType, T.VarcharType)
    if isinstance(old, sized):
        return isinstance(new, T.StringType) or (isinstance(new, sized) and new.length > old.length)
    return False


def _ilike(name: str, pattern: str) -> bool:
    regex = "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in pattern)
    return re.fullmatch(regex, name, re.IGNORECASE | re.DOTALL) is not None


def tables_by_pattern(
    spark: SparkSession, table_pattern: str, exclude: str = "", schema_pattern: str | None = None
) -> dict[str, DataFrame]:
    """Tables whose names match an ILIKE pattern and not `exclude`. With a schema pattern the
    matching databases are searched, otherwise the current one with its temporary views."""
    catalog = spark.catalog
    if schema_pattern is None:
        listed = catalog.listTables()
    else:
        databases = [d.name for d in catalog.listDatabases() if _ilike(d.name, schema_pattern)]
        listed = [t for d in databases for t in catalog.listTables(d) if not t.isTemporary]
    names = {}
    for t in listed:
        if _ilike(t.name, table_pattern) and not (exclude and _ilike(t.name, exclude)):
            full = t.name if t.isTemporary or not t.namespace else ".".join([*t.namespace, t.name])
            names[full] = spark.table(full)
    return dict(sorted(names.items()))


def union_by_pattern(spark, table_pattern, exclude="", schema_pattern=None, **options) -> DataFrame:
    return union_relations(tables_by_pattern(spark, table_pattern, exclude, schema_pattern), **options)


def union_by_prefix(spark, prefix, exclude="", schema_pattern=None, **options) -> DataFrame:
    return union_by_pattern(spark, f"{prefix}%", exclude, schema_pattern, **options)


def symmetric_except(a: DataFrame, b: DataFrame, columns: Sequence[str], precision: int | None = None) -> DataFrame:
    """Distinct rows found on one side only, tagged `a_minus_b` or `b_minus_a`.

    Both sides go through one grouped pass: copies collapse before the shuffle and NULLs compare
    equal, where two anti joins would shuffle each side twice.
    """
    numeric = (T.FloatType, T.DoubleType, T.DecimalType)

    def side(df: DataFrame, in_a: bool) -> DataFrame:
        cells = []
        for c in columns:
            cell = F.col(f"`{c}`")
            if precision is not None and isinstance(df.schema[c].dataType, numeric):
                cell = F.round(cell.cast("decimal(38,12)"), precision)
            cells.append(cell.alias(c))
        return df.select(*cells, F.lit(in_a).alias("_a"), F.lit(not in_a).alias("_b"))

    both = side(a, True).unionAll(side(b, False))
    found = both.groupBy(*columns).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    one_sided = found.where(F.col("_a") != F.col("_b"))
    tag = F.when(F.col("_a"), "a_minus_b").otherwise("b_minus_a").alias("which_diff")
    return one_sided.select(tag, *columns)


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1..upper_bound in column `generated_number`."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def date_spine(spark: SparkSession, datepart: str, start, end) -> DataFrame:
    """One row per date part from `start` up to but not including `end`, spread over tasks."""
    unit = check_datepart(datepart).upper()
    as_time = [as_of_column(x) for x in (start, end)]
    # Boundaries crossed, like SQL datediff: both ends are cut to the date part first.
    cut = [F.date_trunc(datepart, x) for x in as_time]
    steps = spark.range(1).select(F.timestamp_diff(unit, *cut)).first()[0]
    name = f"date_{datepart}"
    return spark.range(max(steps, 0)).select(F.timestamp_add(unit, F.col("id").cast("int"), as_time[0]).alias(name))
