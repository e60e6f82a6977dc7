"""Data checks. A check finds the failing rows of a frame; none means it passed.

Checks on single rows are predicates, so a whole list of them costs one pass: see
:func:`run_checks`. A predicate that is NULL passes. Checks on values shared between rows
aggregate map-side before anything is shuffled and return each failing value once, with
``failures`` rows behind it: a value that fills a third of the table is one row by then.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.ordered import Scan, following, ordered, ranked, running_max
from touchline.sources.tables import scratch_table

Condition = Column | str
FAILURES = "failures"


@dataclass(frozen=True)
class Shared:
    """What a check counts the rows of: values of some columns, and for foreign keys the frame they have to be in."""

    columns: tuple[str, ...]
    where: Condition | None = None
    listed: bool = False
    nulls: bool = False
    parent: DataFrame | None = None
    field: str | None = None
    parent_where: Condition | None = None

    def values(self, df: DataFrame) -> Column | None:
        """``array<string>`` of a row's values; None where text would not tell values apart as their own type does."""
        kinds = dict(df.dtypes)
        own = [kinds.get(name, "") for name in self.columns]
        if self.listed:
            own = [kind.removeprefix("array<").removesuffix(">") for kind in own]
        if not all(kind.startswith(_TOLD_BY_TEXT) for kind in own):
            return None
        if self.parent is not None and dict(self.parent.dtypes)[self.field] != own[0]:
            return None
        if self.listed:
            found = F.transform(F.col(self.columns[0]), lambda value: value.cast("string"))
        elif len(self.columns) > 1:
            found = F.array(F.to_json(F.struct(*[F.col(name).cast("string").alias(f"c{i}") for i, name in enumerate(self.columns)]), {"ignoreNullFields": "false"}))
        else:
            found = F.array(F.col(self.columns[0]).cast("string"))
        if not self.nulls:
            found = F.array_compact(found)
        empty = F.expr("array() :: array<string>")
        found = F.coalesce(found, empty)
        return found if self.where is None else F.when(_condition(self.where), found).otherwise(empty)

    def known(self) -> DataFrame:
        return _chosen(self.parent, self.parent_where).select(F.col(self.field).cast("string").alias("__known")).distinct()


_TOLD_BY_TEXT = ("string", "tinyint", "smallint", "int", "bigint", "decimal", "date", "timestamp", "boolean")


@dataclass(frozen=True)
class Check:
    """``weight`` is the number of failures in a row, for checks a single row can decide.

    ``shared`` describes checks on values of several rows, so that many of them can be counted together.
    """

    name: str
    failing: Callable[[DataFrame], DataFrame]
    weight: Column | None = None
    severity: str = "error"
    shared: Shared | None = None

    def warn(self) -> Check:
        """Report, but do not fail."""
        return replace(self, severity="warn")

    def count(self, df: DataFrame) -> DataFrame:
        found = self.failing(df)
        failures = F.sum(FAILURES) if FAILURES in found.columns else F.count(F.lit(1))
        return found.agg(F.coalesce(failures, F.lit(0)).cast("bigint").alias(FAILURES))


def _condition(condition: Condition) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


def _chosen(df: DataFrame, where: Condition | None) -> DataFrame:
    return df if where is None else df.filter(_condition(where))


def _label(name: str, where: Condition | None) -> str:
    return name if where is None else f"{name} where {where if isinstance(where, str) else 'given'}"


def _row_check(name: str, broken: Column, where: Condition | None) -> Check:
    if where is not None:
        broken = _condition(where) & broken
    return Check(_label(name, where), lambda df: df.filter(broken), F.when(broken, 1).otherwise(0))


# --- single rows -----------------------------------------------------------------------------


def not_null(column: str, where: Condition | None = None) -> Check:
    return _row_check(f"not_null({column})", F.col(column).isNull(), where)


def accepted_values(column: str, values: Sequence, where: Condition | None = None) -> Check:
    return _row_check(f"accepted_values({column})", ~F.col(column).isin(*values), where)


def accepted_range(
    column: str, low=None, high=None, inclusive: bool = True, where: Condition | None = None
) -> Check:
    """Bounds are literals or columns."""
    value = F.col(column)
    outside = F.lit(False)
    if low is not None:
        outside = outside | ((value < low) if inclusive else (value <= low))
    if high is not None:
        outside = outside | ((value > high) if inclusive else (value >= high))
    return _row_check(f"accepted_range({column})", outside, where)


def expression_is_true(expression: Condition, where: Condition | None = None) -> Check:
    text = expression if isinstance(expression, str) else "expression"
    return _row_check(f"is_true({text})", ~_condition(expression), where)


def length_between(column: str, low: int, high: int, where: Condition | None = None) -> Check:
    return _row_check(f"length({column})", ~F.length(column).between(low, high), where)


def length_equals(column: str, length: int, where: Condition | None = None) -> Check:
    return length_between(column, length, length, where)


def greater_than(column: str, other: str, or_equal: bool = False, where: Condition | None = None) -> Check:
    holds = F.col(column) >= F.col(other) if or_equal else F.col(column) > F.col(other)
    return _row_check(f"{column} {'>=' if or_equal else '>'} {other}", ~holds, where)


def min_list_length(column: str, length: int, or_equal: bool = False, where: Condition | None = None) -> Check:
    size = F.array_size(F.col(column))
    return _row_check(f"list_length({column})", ~(size >= length if or_equal else size > length), where)


def no_element_after(column: str, as_of: Column, element: str) -> Check:
    """No element of a list lies after ``as_of``; failures are elements, with the rest of their row."""

    def failing(df: DataFrame) -> DataFrame:
        rest = [name for name in df.columns if name != column]
        return df.select(*rest, F.explode(column).alias(element)).filter(F.col(element) > as_of)

    late = F.size(F.filter(F.col(column), lambda item: item > as_of))
    return Check(f"no_element_after({column})", failing, F.when(F.col(column).isNotNull(), late).otherwise(0))


# --- values shared between rows --------------------------------------------------------------


def unique_combination(columns: Sequence[str], where: Condition | None = None) -> Check:
    """NULL is a value like any other here."""

    def failing(df: DataFrame) -> DataFrame:
        groups = _chosen(df, where).groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
        return groups.filter("rows > 1")

    return Check(_label(f"unique({', '.join(columns)})", where), failing, shared=Shared(tuple(columns), where, nulls=True))


def unique(column: str, where: Condition | None = None) -> Check:
    """NULLs may repeat."""
    combination = unique_combination([column], where)
    return replace(
        combination, failing=lambda df: combination.failing(df.filter(F.col(column).isNotNull())), shared=Shared((column,), where)
    )


def relationships(
    column: str, parent: DataFrame, field: str, where: Condition | None = None, parent_where: Condition | None = None
) -> Check:
    """Every set value of ``column`` exists in ``parent``."""

    def failing(df: DataFrame) -> DataFrame:
        child = _chosen(df, where).filter(F.col(column).isNotNull())
        return _missing(child.select(F.col(column).alias("value")), _chosen(parent, parent_where), field)

    shared = Shared((column,), where, parent=parent, field=field, parent_where=parent_where)
    return Check(_label(f"relationships({column} -> {field})", where), failing, shared=shared)


def list_relationships(column: str, parent: DataFrame, field: str) -> Check:
    """Every element of the list exists in ``parent``; a NULL element does not."""

    def failing(df: DataFrame) -> DataFrame:
        return _missing(df.select(F.explode(column).alias("value")), parent, field)

    shared = Shared((column,), listed=True, nulls=True, parent=parent, field=field)
    return Check(f"list_relationships({column} -> {field})", failing, shared=shared)


def _missing(values: DataFrame, parent: DataFrame, field: str) -> DataFrame:
    counted = values.groupBy("value").agg(F.count(F.lit(1)).alias(FAILURES))
    known = parent.select(F.col(field).alias("__known")).distinct()
    return counted.join(known, F.col("value") == F.col("__known"), "left_anti")


def equal_counts(column: str, x: object, y: object) -> Check:
    """As many rows with ``x`` as with ``y``; if not, both with their number of rows."""

    def failing(df: DataFrame) -> DataFrame:
        counted = df.agg(*[F.count_if(F.col(column) == value).alias(name) for name, value in (("first", x), ("second", y))])
        each = [F.struct(F.lit(value).alias("value"), F.col(name).alias("rows")) for name, value in (("first", x), ("second", y))]
        return counted.filter("first != second").select(F.inline(F.array(*each)))

    return Check(f"equal_counts({column}: {x}, {y})", failing)


def minimum_after(column: str, moment: Column) -> Check:
    """The smallest value lies after ``moment``; if not, every row fails.

    The minimum is one map-side combined aggregate, read as a scalar subquery: a window over
    the whole table would sort it in one task.
    """

    def failing(df: DataFrame) -> DataFrame:
        smallest = df.agg(F.min(column).alias("smallest"))
        return df.filter(~(smallest.scalar() > moment))

    return Check(f"minimum_after({column})", failing)


# --- order within groups ---------------------------------------------------------------------


def no_overlapping_periods(start: str, end: str, id_column: str, keys: Sequence[str], **limits) -> Check:
    """Periods of a group do not overlap; failures are the periods that overlap another one.

    Instead of joining each group with itself: in order of start, a period overlaps an earlier
    one if the latest end before it lies past its start, and a later one if the next start
    lies before its end. Periods without start, end, id or group overlap nothing, and a period
    that ends before it starts is left to :func:`greater_than`. Two rows that share an id and
    overlap are reported too: an id is expected to name one period.
    """

    def failing(df: DataFrame) -> DataFrame:
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (id_column, *keys)])
        valid = df.filter(complete & (F.col(start) <= F.col(end)))
        rows = ordered(valid, keys, [F.col(start), F.col(end), F.col(id_column)], **limits)
        rows = rows.scan(__latest=running_max(end, before_row=True), __next=following(start)).rows
        return rows.filter("__latest > {0} OR __next < {1}".format(start, end)).drop("__latest", "__next")

    return Check(f"no_overlap({start}, {end})", failing)


def not_null_but_latest(column: str, keys: Sequence[str], order: str, **limits) -> Check:
    """Of each group, only the latest row without a value may lack it."""

    def failing(df: DataFrame) -> DataFrame:
        empty = df.filter(F.col(column).isNull())
        newest_first = [F.col(order).desc_nulls_last(), F.xxhash64(*df.columns)]
        rows = ranked(empty, keys, newest_first, "__place", **limits)
        return rows.filter("__place != 1").drop("__place")

    return Check(f"not_null_but_latest({column})", failing)


def scan_is_true(
    condition: Condition,
    keys: Sequence[str],
    order: Sequence[Column | str],
    scans: Mapping[str, Scan],
    where: Condition | None = None,
    **limits,
) -> Check:
    """A condition on values of the ordered group, such as the row before, holds for every row."""

    def failing(df: DataFrame) -> DataFrame:
        rows = ordered(_chosen(df, where), keys, order, **limits).scan(**scans).rows
        return rows.filter(~_condition(condition)).drop(*scans)

    return Check(_label(f"scan_is_true({condition})", where), failing)


# --- suites ----------------------------------------------------------------------------------


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: name, severity and number of failures.

    All single-row checks share one aggregate over one scan. All uniques and foreign keys share another: each row gives
    its values for every check, and equal ones are counted map-side before one shuffle. Only values that may
    fail are kept of that, the repeated ones and the foreign keys; these meet each parent table once.
    """
    fused = [check for check in checks if check.weight is not None]
    results = []
    if fused:
        sums = df.agg(*[F.coalesce(F.sum(c.weight), F.lit(0)).alias(f"c{i}") for i, c in enumerate(fused)])
        rows = [_result(check, F.col(f"c{i}")) for i, check in enumerate(fused)]
        results.append(sums.select(F.inline(F.array(*rows))))
    values = {i: c.shared.values(df) for i, c in enumerate(checks) if c.shared is not None}
    stacked = {i: found for i, found in values.items() if found is not None}
    if len(stacked) > 1:
        results.append(_stacked(df, checks, stacked))
    else:
        stacked = {}
    for i, check in enumerate(checks):
        if check.weight is None and i not in stacked:
            results.append(check.count(df).select(_result(check, F.col(FAILURES)).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, results)


def _stacked(df: DataFrame, checks: Sequence[Check], stacked: Mapping[int, Column]) -> DataFrame:
    """The results of checks on shared values, all counted in one pass."""

    def tagged(i: int, found: Column) -> Column:
        return F.transform(found, lambda value: F.struct(F.lit(i).alias("check"), value.alias("value")))

    each = df.select(F.inline(F.concat(*[tagged(i, found) for i, found in stacked.items()])))
    counted = each.groupBy("check", "value").agg(F.count(F.lit(1)).alias("n"))
    keys = [i for i in stacked if checks[i].shared.parent is not None]
    suspect = scratch_table(counted.filter(F.col("check").isin(keys) | (F.col("n") > 1)), "values")
    # a repeated value is one failure, a missing key as many as it has rows
    failures = suspect.filter(~F.col("check").isin(keys)).groupBy("check").agg(F.count(F.lit(1)).alias(FAILURES))
    parents: dict[tuple, list[int]] = {}
    for i in keys:
        shared = checks[i].shared
        parents.setdefault((id(shared.parent), shared.field, str(shared.parent_where)), []).append(i)
    for own in parents.values():
        known = checks[own[0]].shared.known()
        missing = suspect.filter(F.col("check").isin(own)).join(known, F.col("value") == F.col("__known"), "left_anti")
        failures = failures.unionByName(missing.groupBy("check").agg(F.sum("n").alias(FAILURES)))
    names = [F.struct(F.lit(i).alias("i"), F.lit(checks[i].name).alias("check"), F.lit(checks[i].severity).alias("severity")) for i in stacked]
    listed = df.sparkSession.range(1).select(F.inline(F.array(*names)))
    found = listed.join(failures.withColumnRenamed("check", "at"), F.col("i") == F.col("at"), "left")
    return found.select("check", "severity", F.coalesce(FAILURES, F.lit(0)).cast("bigint").alias(FAILURES))


def _result(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check"),
        F.lit(check.severity).alias("severity"),
        failures.cast("bigint").alias(FAILURES),
    )


class ChecksFailed(AssertionError):
    pass


def require(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``df`` itself if no check of severity error fails; the results are a row per check."""
    failed = run_checks(df, checks).filter(f"severity = 'error' AND {FAILURES} > 0").collect()
    if failed:
        raise ChecksFailed("; ".join(f"{row.check}: {row.failures}" for row in failed))
    return df
