"""Column selection, pivoting, unpivoting and unions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import empty_to_null, slugify_name

# Fixed value: column that names the input a unioned row came from.
SOURCE_COLUMN = "_dbt_source_relation"

_COMPARE = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "like": lambda c, v: F.like(c, v),
    "ilike": lambda c, v: F.ilike(c, v),
}
_DISTINCT = {"sum": F.sum_distinct, "count": F.count_distinct}


def quoted(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def filtered_columns(df: DataFrame, except_: Sequence[str] = ()) -> list[str]:
    """Column names without the excepted ones, upper and lower case alike."""
    hidden = {name.lower() for name in except_}
    return [name for name in df.columns if name.lower() not in hidden]


def star(
    df: DataFrame, except_: Sequence[str] = (), relation_alias: str | None = None, prefix: str = "", suffix: str = ""
) -> list[Column]:
    """Columns to select: all but the excepted ones, renamed with prefix and suffix."""
    owner = f"{relation_alias}." if relation_alias else ""
    return [
        F.col(f"{owner}`{name}`").alias(f"{prefix}{name}{suffix}") for name in filtered_columns(df, except_)
    ]


def nullcheck(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """The columns with '' turned into NULL where they are strings."""
    wanted = list(df.columns if columns is None else columns)
    return [
        empty_to_null(quoted(name)).alias(name)
        if isinstance(df.schema[name].dataType, T.StringType)
        else quoted(name)
        for name in wanted
    ]


def nullcheck_table(df: DataFrame) -> DataFrame:
    return df.select(*nullcheck(df))


def base_model(df: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Every column under its lower-case name."""
    return df if case_sensitive else df.toDF(*[name.lower() for name in df.columns])


def group_by_n(df: DataFrame, n: int):
    """Group by the first ``n`` columns."""
    return df.groupBy(*[quoted(name) for name in df.columns[:n]])


def column_values(
    df: DataFrame,
    column: str,
    order_by: Sequence[tuple[Column, bool]] | None = None,
    max_records: int | None = None,
    where: str | Column | None = None,
) -> DataFrame:
    """Distinct values as column ``value``, the most frequent first.

    ``order_by`` takes (aggregate, ascending) pairs; ties are ordered by value.
    """
    keys = order_by or [(F.count(F.lit(1)), False)]
    rows = df if where is None else df.filter(where)
    sums = [aggregate.alias(f"_order_{i}") for i, (aggregate, _) in enumerate(keys)]
    grouped = rows.groupBy(quoted(column).alias("value")).agg(*sums)
    order = [
        F.col(f"_order_{i}").asc_nulls_last() if up else F.col(f"_order_{i}").desc_nulls_last()
        for i, (_, up) in enumerate(keys)
    ]
    ordered = grouped.orderBy(*order, F.col("value").asc_nulls_last())
    if max_records is not None:
        ordered = ordered.limit(max_records)
    return ordered.select("value")


def column_value_list(
    df: DataFrame | None, column: str, max_records: int, default: list | None = None, **options
) -> list:
    """The first ``max_records`` of ``column_values`` as a list, for naming pivot columns.

    The list comes to the driver, so its length must be bounded; ``pivot_map`` and ``pivot_long`` need no list.
    ``default`` is used when there is no table (``df`` is None) or it has no rows.
    """
    if max_records is None or max_records < 1:
        raise ValueError("a list of values needs a bound")
    if df is None:
        if default is None:
            raise ValueError("the table does not exist and no default was given")
        return default
    rows = column_values(df, column, max_records=max_records, **options).collect()
    return [row["value"] for row in rows] or (default if default is not None else [])


def pivot_long(df: DataFrame, group_by: Sequence[str], column: str, *aggregates: Column) -> DataFrame:
    """The cells of a pivot as rows (group, value, aggregates): any number of values, nothing on the driver."""
    return df.groupBy(*[quoted(name) for name in group_by], quoted(column).alias("value")).agg(*aggregates)


def pivot_columns(
    column: str,
    values: Sequence,
    alias: bool = True,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: Column | str | float = 1,
    else_value: Column | str | float | None = 0,
    quote_identifiers: bool = True,
    distinct: bool = False,
) -> list[Column]:
    """One conditional aggregate per value; use them in ``groupBy(...).agg(...)``."""

    def operand(value) -> Column:
        if isinstance(value, Column):
            return value
        return F.expr(value) if isinstance(value, str) else F.lit(value)

    out = []
    for value in values:
        matches = _COMPARE[cmp.lower()](quoted(column), F.lit(value))
        hit = F.when(matches, operand(then_value)).otherwise(operand(else_value))
        if distinct and agg in _DISTINCT:
            result = _DISTINCT[agg](hit)
        else:
            result = F.call_function(agg, hit)
        if alias:
            name = f"{prefix}{value}{suffix}"
            result = result.alias(name if quote_identifiers else slugify_name(name))
        out.append(result)
    return out


def _pivot_distinct(
    df: DataFrame, group_by: Sequence[str], column: str, values: Sequence, agg: str, then_value, else_value, named: Callable[[object], str]
) -> DataFrame:
    """A pivot over distinct operands of equal values: rows are made distinct per group, value and operand, then aggregated.

    Of the rows that do not match, all that counts is that there is one: they give the else value once, unless a
    matching row gives it as well.
    """
    operand = then_value if isinstance(then_value, Column) else F.expr(then_value) if isinstance(then_value, str) else F.lit(then_value)
    hit = F.when(F.lit(True), operand).otherwise(F.lit(else_value))  # the type that both share
    keys = [quoted(name) for name in group_by]
    cells = df.select(*keys, quoted(column).alias("_value"), hit.alias("_operand")).distinct()
    out = []
    for value in values:
        matches = F.coalesce(F.col("_value") == F.lit(value), F.lit(False))
        own = F.when(matches, F.col("_operand"))
        if else_value is None:
            other = F.lit(None)
        else:
            same = F.coalesce(F.col("_operand") == F.lit(else_value), F.lit(False))
            other = F.when(F.bool_or(~matches) & ~F.bool_or(matches & same), F.lit(else_value))
        if agg == "count":
            result = F.count(own) + F.when(other.isNotNull(), 1).otherwise(0)
        else:
            summed = F.sum(own)
            result = F.when(summed.isNull(), other).when(other.isNull(), summed).otherwise(summed + other)
        out.append(result.alias(named(value)))
    return cells.groupBy(*keys).agg(*out)


def pivot(df: DataFrame, group_by: Sequence[str], column: str, values: Sequence, **options) -> DataFrame:
    """One row per group, one column per value; combinations without rows give the else value.

    Distinct sums and counts of equal values go in two phases; other comparisons let Spark expand the rows once per value.
    """
    plain = not isinstance(options.get("else_value", 0), (Column, str))
    agg, same = options.get("agg", "sum"), options.get("cmp", "=") == "="
    if options.get("distinct") and agg in _DISTINCT and same and plain and options.get("alias", True):
        prefix, suffix = options.get("prefix", ""), options.get("suffix", "")

        def named(value) -> str:
            name = f"{prefix}{value}{suffix}"
            return name if options.get("quote_identifiers", True) else slugify_name(name)

        return _pivot_distinct(df, group_by, column, values, agg, options.get("then_value", 1), options.get("else_value", 0), named)
    return df.groupBy(*[quoted(name) for name in group_by]).agg(*pivot_columns(column, values, **options))


def pivot_map(df: DataFrame, group_by: Sequence[str], column: str, aggregate: Column, out: str = "cells") -> DataFrame:
    """One row per group with a map of value to aggregate: the values need not be known, and none goes through the driver.

    Rows are aggregated per group and value first; a NULL value is left out, as a map has no such key. A map holds one
    entry per value of its group; where a group may have very many values, ``pivot_long`` keeps them as rows.
    """
    cells = pivot_long(df.filter(quoted(column).isNotNull()), group_by, column, aggregate.alias("_cell"))
    entries = F.array_sort(F.collect_list(F.struct("value", "_cell")))
    found = cells.groupBy(*[quoted(name) for name in group_by]).agg(F.map_from_entries(entries).alias(out))
    return found


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """One row per remaining column, its value cast to one type; ``exclude`` is kept, ``remove`` dropped."""
    fields = filtered_columns(df, [*exclude, *remove])
    cast = df.select(*[quoted(n) for n in exclude], *[quoted(n).cast(cast_to).alias(n) for n in fields])
    return cast.unpivot(
        [quoted(n) for n in exclude], [quoted(n) for n in fields], field_name, value_name
    )


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = SOURCE_COLUMN,
    where: str | Column | None = None,
) -> DataFrame:
    """UNION ALL over all columns of all inputs; a missing column is NULL, the first type seen wins."""
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    wanted = {name.lower() for name in include}
    hidden = {name.lower() for name in exclude}
    types: dict[str, tuple[str, T.DataType]] = {}
    for df in relations.values():
        for field in df.schema.fields:
            key = field.name.lower()
            if key not in hidden and (not wanted or key in wanted):
                types.setdefault(key, (field.name, field.dataType))
    if not types and (include or exclude):
        raise ValueError(f"no columns left to union for {', '.join(relations)}")
    override = {name.lower(): kind for name, kind in (column_override or {}).items()}

    def aligned(label: str, df: DataFrame) -> DataFrame:
        present = {name.lower() for name in df.columns}
        columns = [
            (quoted(name) if key in present else F.lit(None)).cast(override.get(key, kind)).alias(name)
            for key, (name, kind) in types.items()
        ]
        if source_column_name is not None:
            columns.insert(0, F.lit(label).alias(source_column_name))
        return (df if where is None else df.filter(where)).select(*columns)

    parts = [aligned(label, df) for label, df in relations.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
