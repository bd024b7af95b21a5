"""Run many checks and summarise them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import quality as q
from .reshape import quoted

# Conditions of a row that breaks a check.
_ROW_CHECKS: dict[str, Callable[..., Column]] = {
    "accepted_range": lambda column, **a: q.outside_range(quoted(column), **a),
    "expression_is_true": lambda expression, column=None: q.breaks_expression(expression, column),
    "not_empty_string": lambda column, **a: q.is_blank(quoted(column), **a),
    "not_null": lambda column: quoted(column).isNull(),
    "assert_equal": lambda actual, expected: quoted(actual) != quoted(expected),
}
# Checks whose violations are rows of their own: of two tables, or of the order of rows. All are counted, never expanded.
_TABLE_CHECKS: dict[str, Callable[..., DataFrame]] = {
    "relationships_where": q.relationships_where_counted,
    "sequential_values": q.sequential_values_counted,
    "mutually_exclusive_ranges": q.mutually_exclusive_ranges_counted,
    "cardinality_equality": q.cardinality_equality,
    "equal_rowcount": q.equal_rowcount,
    "fewer_rows_than": q.fewer_rows_than,
    "equality": q.equality,
}


_ONE_PASS_CHECKS = [
    "unique", "unique_combination_of_columns", "accepted_values", "not_accepted_values", "at_least_one", "not_constant", "not_null_proportion",
    "recency",
]
KINDS = {*_ROW_CHECKS, *_ONE_PASS_CHECKS, *_TABLE_CHECKS}


@dataclass(frozen=True)
class Check:
    """One check: which table, which kind, its arguments, and when it counts as failed."""

    name: str
    table: str
    kind: str
    args: Mapping = field(default_factory=dict)
    where: str | None = None
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    severity: str = "error"


@dataclass(frozen=True)
class _State:
    """What a check keeps of each group of rows: mergeable aggregates, and the failures they mean."""

    keys: tuple[str, ...]
    aggregates: dict[str, Column]
    failures: Column


def _one(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long")


def _state(check: Check, df: DataFrame, name: str) -> _State | None:
    """The state of a check that one pass over one table can decide; its aggregates are called ``name`` and a letter."""
    args, where = dict(check.args), F.lit(True) if check.where is None else F.coalesce(F.expr(check.where), F.lit(False))
    keys = tuple(args.pop("group_by", ()))
    n, a, b = F.col(f"{name}n"), F.col(f"{name}a"), F.col(f"{name}b")
    rows = {f"{name}n": F.count_if(where)}
    if check.kind in _ROW_CHECKS:
        return _State((), {f"{name}n": F.count_if(where & _ROW_CHECKS[check.kind](**args))}, n)
    column = quoted(args["column"]) if "column" in args else None
    if check.kind == "unique":
        return _State((args["column"],), rows, _one(column.isNotNull() & (n > 1)))
    if check.kind == "unique_combination_of_columns":
        return _State(tuple(args["columns"]), rows, _one(n > 1))
    if check.kind in ("accepted_values", "not_accepted_values"):
        listed = column.isin(*args["values"])
        return _State((args["column"],), rows, _one((n > 0) & (~listed if check.kind == "accepted_values" else listed)))
    some = (n > 0) if keys else F.lit(True)  # without groups the table is one, also when it is empty
    if check.kind == "at_least_one":
        return _State(keys, {**rows, f"{name}a": F.count_if(where & column.isNotNull())}, _one(some & (a == 0)))
    if check.kind == "not_constant":
        given = F.when(where, column)
        return _State(keys, {f"{name}a": F.min(given), f"{name}b": F.max(given)}, _one(a == b))
    if check.kind == "not_null_proportion":
        share = F.try_divide(a.cast("double"), n.cast("double"))
        outside = (share < F.lit(args["at_least"])) | (share > F.lit(args.get("at_most", 1.0)))
        return _State(keys, {**rows, f"{name}a": F.count_if(where & column.isNotNull())}, _one(outside))
    if check.kind == "recency":
        field = args.pop("field")
        newest = F.max(F.when(where, quoted(field)))
        newest = newest.cast("date") if args.get("ignore_time_component") else newest
        return _State(keys, {f"{name}a": newest}, _one(a < q.recency_threshold(df.schema[field].dataType, **args)))
    return None


def _failures(kind: str, violations: DataFrame) -> DataFrame:
    """The number a check is judged by, as one row."""
    if kind == "equal_rowcount":
        total = F.sum(F.coalesce("diff_count", F.lit(0)))
    elif kind == "fewer_rows_than":
        total = F.sum(F.coalesce("row_count_delta", F.lit(0)))
    elif kind == "equality":
        sides = [F.count_if(F.col("which_diff") == side) for side in ("a_minus_b", "b_minus_a")]
        total = F.count(F.lit(1)) + F.abs(sides[0] - sides[1])
    elif q.COPIES in violations.columns:
        total = F.sum(q.COPIES)
    else:
        total = F.count(F.lit(1))
    return violations.agg(F.coalesce(total, F.lit(0)).cast("long").alias("failures"))


def _status(check: Check) -> Column:
    fails = F.expr(f"failures {check.error_if}") if check.severity == "error" else F.lit(False)
    return F.when(fails, "fail").when(F.expr(f"failures {check.warn_if}"), "warn").otherwise("pass")


def _one_pass(df: DataFrame, table: str, keys: tuple[str, ...], group: list[tuple[Check, _State]]) -> DataFrame:
    """All checks of one table that share their keys: one scan, partial aggregates below the shuffle."""
    aggregates = [column.alias(name) for _, state in group for name, column in state.aggregates.items()]
    states = df.groupBy(*[quoted(key) for key in keys]).agg(*aggregates)
    if keys:
        totals = [F.coalesce(F.sum(state.failures), F.lit(0)).alias(f"c{i}") for i, (_, state) in enumerate(group)]
        counts = states.agg(*totals)
    else:
        counts = states.select(*[state.failures.alias(f"c{i}") for i, (_, state) in enumerate(group)])
    labelled = F.array(
        *[F.struct(F.lit(check.name).alias("check"), F.col(f"c{i}").cast("long").alias("failures")) for i, (check, _) in enumerate(group)]
    )
    chain = reduce(lambda out, pair: out.when(F.col("check") == pair[0].name, _status(pair[0])), group, F)
    pairs = counts.select(F.inline(labelled))
    return pairs.select("check", F.lit(table).alias("table_name"), "failures", chain.alias("status"))


def dq_run(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """check, table_name, failures and status of every check.

    A check on one table is a set of mergeable aggregates (counts, smallest, largest) per group of rows. Checks of a
    table with the same groups share one scan: one for everything without groups, one per set of keys. Checks that
    compare tables or look at the order of rows are a small query each; their violations are counted, not expanded.
    """
    parts = []
    for table, df in tables.items():
        groups: dict[tuple[str, ...], list[tuple[Check, _State]]] = {}
        for i, check in enumerate(checks):
            if check.table != table:
                continue
            state = _state(check, df, f"_state{i}") if check.kind in KINDS else None
            if state is not None:
                groups.setdefault(state.keys, []).append((check, state))
            elif check.kind in _TABLE_CHECKS:
                rows = df if check.where is None else df.filter(check.where)
                args = {k: tables[v] if k in ("to", "compare") and isinstance(v, str) else v for k, v in check.args.items()}
                total = _failures(check.kind, _TABLE_CHECKS[check.kind](rows, **args))
                parts.append(
                    total.select(
                        F.lit(check.name).alias("check"), F.lit(table).alias("table_name"), "failures", _status(check).alias("status")
                    )
                )
        parts += [_one_pass(df, table, keys, group) for keys, group in groups.items()]
    unknown = [c.name for c in checks if c.kind not in KINDS or c.table not in tables]
    if unknown:
        raise ValueError(f"checks of an unknown kind or table: {', '.join(unknown)}")
    return reduce(DataFrame.union, parts)
