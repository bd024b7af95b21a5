"""Data-quality checks.

Each check returns the violating rows, so no rows means "pass". The two row
count comparisons return every group; ``failures`` sums up what counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import slugify_name
from .neighbours import repeat_rows, with_neighbour
from .reshape import filtered_columns, quoted

_NUMERIC = "decimal(28,6)"
# How often a row of a counted result occurs.
COPIES = "_copies"
_GAP_RULES = {
    "allowed": (lambda upper, following: upper <= following, "less_than_or_equal_to"),
    "not_allowed": (lambda upper, following: upper == following, "equal_to"),
    "required": (lambda upper, following: upper < following, "less_than"),
}


def _expr(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def _literal(value) -> Column:
    """A bound: SQL text, a column, or a plain value."""
    return _expr(value) if isinstance(value, (str, Column)) else F.lit(value)


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out


# --- conditions that hold for a violating row; also folded into one pass by dq_run ---


def outside_range(column: Column, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    """NULL values and missing bounds never violate."""
    wrong = []
    if min_value is not None:
        low = _literal(min_value)
        wrong.append(column < low if inclusive else column <= low)
    if max_value is not None:
        high = _literal(max_value)
        wrong.append(column > high if inclusive else column >= high)
    return _any(wrong)


def is_blank(column: Column, trim_whitespace: bool = True) -> Column:
    return (F.trim(column) if trim_whitespace else column) == ""


def breaks_expression(expression: str, column: str | None = None) -> Column:
    return ~F.expr(expression if column is None else f"{column} {expression}")


# --- row-level checks ---


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    return df.filter(outside_range(quoted(column), min_value, max_value, inclusive))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows for which the expression is false; NULL passes."""
    return df.filter(breaks_expression(expression, column))


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    text = F.trim(quoted(column)) if trim_whitespace else quoted(column)
    return df.filter(is_blank(quoted(column), trim_whitespace)).select(text.alias(column))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(quoted(column).isNull())


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows whose two columns differ; a NULL on either side passes."""
    return df.filter(quoted(actual) != quoted(expected))


# --- checks on values and groups ---


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    counted = df.filter(quoted(column).isNotNull()).groupBy(quoted(column).alias("unique_field"))
    return counted.agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their number of rows."""
    counted = df.groupBy(quoted(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(~F.col("value_field").isin(*values))


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Forbidden values that occur."""
    return df.filter(quoted(column).isin(*values)).select(quoted(column).alias("value_field")).distinct()


def unique_combination_of_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; NULLs are alike."""
    grouped = df.groupBy(*[quoted(c) for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    return grouped.filter(F.col("_n") > 1).drop("_n")


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups without any value; an ungrouped table without any value gives one row."""
    if group_by:
        rows = df.groupBy(*[quoted(g) for g in group_by])
    else:
        rows = df.filter(quoted(column).isNotNull()).select(quoted(column)).limit(1)
    return rows.agg(F.count(quoted(column)).alias("filler_column")).filter(F.col("filler_column") == 0)


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups with exactly one distinct value.

    Smallest = largest says the same as "count distinct = 1" and needs no shuffle of the values.
    """
    bounds = df.groupBy(*[quoted(g) for g in group_by]).agg(
        F.min(quoted(column)).alias("_min"), F.max(quoted(column)).alias("_max")
    )
    return bounds.filter(F.col("_min") == F.col("_max")).select(
        *[quoted(g) for g in group_by], F.lit(1).cast("long").alias("filler_column")
    )


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    """Groups whose share of non-NULL values is out of bounds."""
    share = F.count(quoted(column)).cast("double") / F.count(F.lit(1)).cast("double")
    shares = df.groupBy(*[quoted(g) for g in group_by]).agg(share.alias("not_null_proportion"))
    value = F.col("not_null_proportion")
    return shares.filter((value < F.lit(at_least)) | (value > F.lit(at_most)))


def recency_threshold(
    stored: T.DataType, datepart: str, interval: int, ignore_time_component: bool = False, as_of: Column | str | None = None
) -> Column:
    """The time that a newest value must not lie before."""
    if as_of is None:
        now = F.current_timestamp()
    else:
        now = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    timed = stored if isinstance(stored, (T.TimestampType, T.TimestampNTZType)) else T.TimestampNTZType()
    kind = T.DateType() if ignore_time_component else timed
    return F.timestamp_add(datepart.upper(), F.lit(-interval), now).cast(kind)


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    ignore_time_component: bool = False,
    group_by: Sequence[str] = (),
    as_of: Column | str | None = None,
) -> DataFrame:
    """Groups whose newest value is older than ``as_of`` minus the interval.

    ``as_of`` is the current time unless given; text is taken as a timestamp.
    """
    threshold = recency_threshold(df.schema[field].dataType, datepart, interval, ignore_time_component, as_of)
    newest = F.max(quoted(field))
    if ignore_time_component:
        newest = newest.cast("date")
    groups = df.groupBy(*[quoted(g) for g in group_by]).agg(newest.alias("most_recent"))
    return groups.withColumn("threshold", threshold).filter(F.col("most_recent") < F.col("threshold"))


# --- comparisons of two tables ---


def relationships_where(
    df: DataFrame,
    column: str,
    to: DataFrame,
    field: str,
    from_condition: str | Column = "true",
    to_condition: str | Column = "true",
) -> DataFrame:
    """Values without a partner in ``to``, once per row that holds them."""
    missing = relationships_where_counted(df, column, to, field, from_condition, to_condition)
    right_id = F.lit(None).cast(to.schema[field].dataType)
    return repeat_rows(missing, COPIES).withColumn("right_id", right_id)


def relationships_where_counted(
    df: DataFrame,
    column: str,
    to: DataFrame,
    field: str,
    from_condition: str | Column = "true",
    to_condition: str | Column = "true",
) -> DataFrame:
    """Values without a partner in ``to``, each with the number of rows that hold it.

    Both sides are counted down to distinct values before the join, so a value
    held by very many rows is one row in the shuffle.
    """
    left = df.filter(_expr(from_condition)).filter(quoted(column).isNotNull())
    right = to.filter(_expr(to_condition)).filter(quoted(field).isNotNull())
    ids = left.groupBy(quoted(column).alias("id")).agg(F.count(F.lit(1)).alias(COPIES))
    partners = right.select(quoted(field).alias("id")).distinct()
    return ids.join(partners, "id", "left_anti")


DIGEST_BUCKETS = 4096


def _digestible(kind: T.DataType) -> bool:
    """Whether equal values of the type have equal hashes; nested values and collated text are compared as they are."""
    plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
    return isinstance(kind, plain) or kind == T.StringType()


def _in_differing_buckets(both: DataFrame, columns: Sequence[str], in_a: Column) -> DataFrame:
    """The rows that lie in a bucket of hashes whose contents are not the same on both sides.

    Each bucket has an order-free digest: the rows, two sums and a xor of row hashes, those of the second side counted
    off. Digests are combined below the shuffle, so equal tables shuffle DIGEST_BUCKETS rows a task and no row of
    their own; of tables that differ only differing buckets go on. A bucket with a difference passes as equal with
    probability 2^-64 at most. The list of buckets is bounded by its constant, so every task gets it.
    """
    kinds = {field.name: field.dataType for field in both.schema.fields}
    if not all(_digestible(kinds[name]) for name in columns):
        return both

    def hashed(name: str) -> Column:
        # Equal for grouping, but not for a hash: 0.0 and -0.0.
        fraction = isinstance(kinds[name], (T.FloatType, T.DoubleType))
        return quoted(name) + F.lit(0.0).cast(kinds[name]) if fraction else quoted(name)

    # A hash skips NULLs, so their places are part of what is hashed.
    values = [part for name in columns for part in (quoted(name).isNull(), hashed(name))]
    rows = both.withColumn("_hash", F.xxhash64(*values))
    rows = rows.withColumn("_bucket", F.pmod(F.col("_hash"), F.lit(DIGEST_BUCKETS)).cast("int"))
    side = F.when(in_a, F.lit(1)).otherwise(F.lit(-1))
    sums = {
        "_rows": F.sum(side),
        "_low": F.sum(side * F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF))),
        "_high": F.sum(side * F.shiftrightunsigned("_hash", 32)),
        "_xor": F.bit_xor(F.xxhash64(F.lit(1), *values)),
    }
    digests = rows.groupBy("_bucket").agg(*[value.alias(name) for name, value in sums.items()])
    differing = digests.filter(" OR ".join(f"{name} <> 0" for name in sums)).select("_bucket")
    return rows.join(F.broadcast(differing), "_bucket", "left_semi").drop("_bucket", "_hash")


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str, by_digest: bool = False) -> DataFrame:
    """(value, rows) pairs that occur on one side only, from one aggregation over both sides.

    ``by_digest`` compares digests of buckets first, so that values of equal buckets are never shuffled (see ``equality``).
    """
    ours = df.select(quoted(column).alias(column), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    theirs = to.select(quoted(field).alias(column), F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    both = ours.union(theirs)
    if by_digest:
        both = _in_differing_buckets(both, [column], F.col("_a") == 1)
    counts = both.groupBy(quoted(column)).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    sides = counts.filter(F.col("_a") != F.col("_b")).withColumn("num_rows", F.explode(F.array("_a", "_b")))
    return sides.filter(F.col("num_rows") > 0).select(quoted(column), "num_rows")


def _paired_counts(df: DataFrame, other: DataFrame, group_by: Sequence[str], ours: str, theirs: str) -> DataFrame:
    """Row counts of both sides, matched by group; a NULL group stays unmatched."""

    def counts(rows: DataFrame, side: str, name: str) -> DataFrame:
        # The constant key makes an empty table a missing group instead of a count of 0.
        keys = [F.lit(1).alias(f"_all_{side}"), *[quoted(g).alias(f"{g}_{side}") for g in group_by]]
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    same = F.col("_all_a") == F.col("_all_b")
    for g in group_by:
        same = same & (quoted(f"{g}_a") == quoted(f"{g}_b"))
    keys = [quoted(f"{g}_{side}") for g in group_by for side in ("a", "b")]
    joined = counts(df, "a", ours).join(counts(other, "b", theirs), same, "full_outer")
    return joined.select(*keys, ours, theirs)


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Counts per group; the check fails when the sum of ``diff_count`` is not 0."""
    counts = _paired_counts(df, compare, group_by, "count_a", "count_b")
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Counts per group; the check fails when the sum of ``row_count_delta`` is not 0."""
    counts = _paired_counts(df, compare, group_by, "count_our_model", "count_comparison_model")
    more = F.col("count_our_model") - F.col("count_comparison_model")
    delta = F.when(more > 0, more).when(more == 0, F.lit(1)).otherwise(F.lit(0))
    return counts.withColumn("row_count_delta", delta.cast("long"))


def equality(
    df: DataFrame,
    compare: DataFrame,
    compare_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    precision: int | None = None,
    by_digest: bool = False,
) -> DataFrame:
    """Rows that occur on one side only, duplicates ignored, with ``which_diff``.

    Both sides go through one aggregation instead of two EXCEPTs. ``by_digest`` is for large tables that are expected to
    be equal or nearly so: digests of hash buckets are compared first, and only rows of buckets with a difference are
    shuffled. It reads the tables twice where there is one. The same rows in other numbers give no row either way.
    """
    if compare_columns and exclude_columns:
        raise ValueError("give either compare_columns or exclude_columns, not both")
    if compare_columns:
        columns = list(compare_columns)
    else:
        columns = filtered_columns(df, exclude_columns or ())
        other = filtered_columns(compare, exclude_columns or ())
        if {c.lower() for c in columns} != {c.lower() for c in other}:
            raise ValueError("the tables have different columns; use compare_columns or exclude_columns")

    def side(rows: DataFrame, in_a: bool) -> DataFrame:
        kinds = {field.name.lower(): field.dataType for field in df.schema.fields}

        def compared(name: str) -> Column:
            if precision and isinstance(kinds.get(name.lower()), T.NumericType):
                return F.round(quoted(name).cast(_NUMERIC), precision).alias(name)
            return quoted(name).alias(name)

        return rows.select(
            *[compared(c) for c in columns], F.lit(in_a).alias("_in_a"), F.lit(not in_a).alias("_in_b")
        )

    both = side(df, True).union(side(compare, False))
    if by_digest:
        both = _in_differing_buckets(both, columns, F.col("_in_a"))
    seen = both.groupBy(*[quoted(c) for c in columns]).agg(
        F.bool_or("_in_a").alias("_in_a"), F.bool_or("_in_b").alias("_in_b")
    )
    which = F.when(F.col("_in_a"), F.lit("a_minus_b")).otherwise(F.lit("b_minus_a"))
    return seen.filter(F.col("_in_a") != F.col("_in_b")).select(which.alias("which_diff"), *[quoted(c) for c in columns])


# --- checks on the order of rows ---


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Rows that are not one interval after the previous one of their group; NULLs and first rows pass."""
    return repeat_rows(sequential_values_counted(df, column, interval, datepart, group_by), COPIES)


def sequential_values_counted(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """``sequential_values`` with equal rows as one, and their number."""
    previous = f"previous_{slugify_name(column)}"
    rows = df.filter(quoted(column).isNotNull()).select(*[quoted(g) for g in group_by], quoted(column))

    def breaks(value: Column, before: Column) -> Column:
        if datepart is None:
            return value != before + interval
        return value.cast("timestamp_ntz") != F.timestamp_add(
            datepart.upper(), F.lit(interval), before.cast("timestamp_ntz")
        )

    # Equal values are counted first; every copy but one has the value itself before it.
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    found = with_neighbour(counted, group_by, [column], column, "_before", following=False, sample_from=rows)
    cases = F.array(
        F.struct(F.col("_before").alias("before"), F.lit(1).cast("long").alias("copies")),
        F.struct(quoted(column).alias("before"), (F.col("_n") - 1).alias("copies")),
    )
    flat = found.withColumn("_case", F.explode(cases)).select(
        *[quoted(c) for c in rows.columns],
        F.col("_case.before").alias(previous),
        F.col("_case.copies").alias(COPIES),
    )
    return flat.filter((F.col(COPIES) > 0) & breaks(quoted(column), quoted(previous)))


def mutually_exclusive_ranges_counted(
    df: DataFrame,
    lower: Column | str,
    upper: Column | str,
    partition_by: Column | str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> DataFrame:
    """``mutually_exclusive_ranges`` with equal ranges as one, and their number."""
    if gaps not in _GAP_RULES:
        raise ValueError(f"gaps must be one of {sorted(_GAP_RULES)}, got {gaps!r}")
    fits, words = _GAP_RULES[gaps]
    length_name = "lower_bound_" + ("less_than_or_equal_to" if zero_length_range_allowed else "less_than") + "_upper_bound"
    gap_name = f"upper_bound_{words}_next_lower_bound"
    groups = [] if partition_by is None else ["partition_by_col"]
    rows = df.select(
        *([] if partition_by is None else [_expr(partition_by).alias("partition_by_col")]),
        _expr(lower).alias("lower_bound"),
        _expr(upper).alias("upper_bound"),
    )
    low, high, following = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")

    def judged(part: DataFrame) -> DataFrame:
        long_enough = low <= high if zero_length_range_allowed else low < high
        last = following.isNull() & low.isNotNull()
        return (
            part.withColumn("is_last_record", last)
            .withColumn(length_name, F.coalesce(long_enough, F.lit(False)))
            .withColumn(gap_name, F.coalesce(fits(high, following), F.col("is_last_record")))
            .filter(~(F.col(length_name) & F.col(gap_name)))
        )

    # Equal ranges are counted first; every copy but the last is followed by its own lower bound.
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    found = with_neighbour(counted, groups, ["lower_bound", "upper_bound"], "lower_bound", "_after", following=True, sample_from=rows)
    cases = F.array(
        F.struct(F.col("_after").alias("after"), F.lit(1).cast("long").alias("copies")),
        F.struct(low.alias("after"), (F.col("_n") - 1).alias("copies")),
    )
    flat = found.withColumn("_case", F.explode(cases)).select(
        *rows.columns, F.col("_case.after").alias("next_lower_bound"), F.col("_case.copies").alias(COPIES)
    )
    return judged(flat.filter(F.col(COPIES) > 0))


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: Column | str,
    upper: Column | str,
    partition_by: Column | str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> DataFrame:
    """Ranges that overlap the next one of their group, are empty or have a NULL bound."""
    return repeat_rows(mutually_exclusive_ranges_counted(df, lower, upper, partition_by, gaps, zero_length_range_allowed), COPIES)
