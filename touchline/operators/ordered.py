"""Running values over ordered groups, whatever the size of a group.

A plain window puts a whole group into one task. That is right for many small groups and
wrong when one key holds a large share of the rows. ``ordered`` counts the groups first
(map-side combined, one number comes back). While every group fits, scans are ordinary
window functions sharing one shuffle and one sort. Otherwise the rows are range-partitioned
by group *and* order, so a big group spreads over many segments of bounded size:

1. each segment computes its scans alone;
2. each segment leaves one summary row per group (sums, counts, first and last values);
3. summaries of earlier (or later) segments are carried into the rows of a segment.

Step 3 only concerns groups that cross a segment border, at most one per border, so what is
carried around is bounded by the number of segments and not by the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.functions._columns import as_column
from touchline.sources.tables import scratch_table

MAX_GROUP_ROWS = 4_000_000
"""Largest group one task may sort; beyond it groups are cut into segments."""

SEGMENT_ROWS = 2_000_000
"""Rows aimed at per segment."""

MAX_SEGMENTS = 50_000
"""Beyond it segments grow instead: the carried rows, at most two per segment, stay broadcastable."""

_SEGMENT = "__segment"
_PLACE = "__segment_place"
_LAST = "__segment_last"


@dataclass(frozen=True)
class Scan:
    """One running value; build it with the functions below."""

    kind: str
    value: Column
    before_row: bool = False


def running_sum(value: Column | str) -> Scan:
    """Sum from the first row of the group to this one."""
    return Scan("sum", as_column(value))


def running_count(condition: Column | str) -> Scan:
    """Number of rows so far for which the condition holds."""
    return Scan("count", as_column(condition))


def running_max(value: Column | str, before_row: bool = False) -> Scan:
    """Largest value so far; with ``before_row`` this row is left out."""
    return Scan("max", as_column(value), before_row)


def row_number() -> Scan:
    """1, 2, 3 .. within the group."""
    return Scan("count", F.lit(True))


def previous(value: Column | str) -> Scan:
    """The value one row earlier; NULL on the first row."""
    return Scan("previous", as_column(value))


def following(value: Column | str) -> Scan:
    """The value one row later; NULL on the last row."""
    return Scan("following", as_column(value))


class Ordered:
    """Rows with a group and an order, ready for scans. Made by :func:`ordered`."""

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[Column], segmented: bool):
        self._df = df
        self._keys = list(keys)
        self._order = list(order)
        self.segmented = segmented

    @property
    def rows(self) -> DataFrame:
        return self._df.drop(_SEGMENT) if self.segmented else self._df

    def with_columns(self, **columns: Column) -> Ordered:
        """Add plain columns, for instance from the scans made so far."""
        return Ordered(self._df.withColumns(columns), self._keys, self._order, self.segmented)

    def scan(self, **scans: Scan) -> Ordered:
        """Add one column for each scan."""
        groups = [_SEGMENT, *self._keys] if self.segmented else self._keys
        window = W.partitionBy(*groups).orderBy(*self._order)
        local = self._df.withColumns({name: _local(scan, window) for name, scan in scans.items()})
        df = self._with_carry(local, window, scans) if self.segmented else local
        return Ordered(df, self._keys, self._order, self.segmented)

    def _with_carry(self, local: DataFrame, window, scans: dict[str, Scan]) -> DataFrame:
        edges = any(scan.kind in ("previous", "following") for scan in scans.values())
        if edges:
            local = local.withColumns(
                {_PLACE: F.row_number().over(window), _LAST: F.lead(F.lit(True)).over(window).isNull()}
            )
        groups = [_SEGMENT, *self._keys]
        summaries = local.groupBy(*groups).agg(*[_summary(s).alias(_carried(n)) for n, s in scans.items()])

        # one row per group and segment: a group has at most as many rows here as there are segments
        across = W.partitionBy(*self._keys).orderBy(_SEGMENT)
        earlier = across.rowsBetween(W.unboundedPreceding, -1)
        carry = summaries.select(
            F.col(_SEGMENT).alias("__at"),
            *[F.col(key).alias(f"__key{i}") for i, key in enumerate(self._keys)],
            *[_carry(_carried(n), s, across, earlier).alias(_carried(n)) for n, s in scans.items()],
            F.count(F.lit(1)).over(W.partitionBy(*self._keys)).alias("__spread"),
        ).filter("__spread > 1")

        same = F.col(_SEGMENT) == F.col("__at")
        for i, key in enumerate(self._keys):
            same = same & F.col(key).eqNullSafe(F.col(f"__key{i}"))
        # Bounded by MAX_SEGMENTS, so the rows can stay where they are. Written first: making it
        # is a pass over all rows, longer than a broadcast may take, and later scans reuse it.
        joined = local.join(F.broadcast(scratch_table(carry, "carry")), same, "left")
        joined = joined.withColumns({n: _combined(n, s) for n, s in scans.items()})
        return joined.select(*[column for column in local.columns if column not in (_PLACE, _LAST)])


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    *,
    sizes: DataFrame | None = None,
    reuse: bool = False,
    max_group_rows: int | None = None,
    segment_rows: int | None = None,
) -> Ordered:
    """Group ``df`` by ``keys`` and order it for scans.

    ``order`` should end in something unique within the group: then results are fully
    determined, and a run of equal values can still be cut.

    The size check reads ``df`` once more, keys only. To spare that, pass ``sizes``: a frame
    with ``rows``, the size of a group or an upper bound of it, and ``total``, the rows of all
    groups that holds for. With ``reuse`` the frame is first written to the shared folder; use
    it where ``df`` is small next to what it was made from, such as an aggregate.
    """
    limit = MAX_GROUP_ROWS if max_group_rows is None else max_group_rows
    aim = SEGMENT_ROWS if segment_rows is None else segment_rows
    order = [as_column(column) for column in order]
    if reuse:
        df = scratch_table(df, "ordered")
    if sizes is None:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).withColumn("total", F.col("rows"))
    largest, total = sizes.agg(F.max("rows"), F.sum("total")).first()
    if (largest or 0) <= limit:
        return Ordered(df, keys, order, segmented=False)
    segments = min(MAX_SEGMENTS, max(2, math.ceil(total / aim)))
    by_group = [F.col(key).asc_nulls_first() for key in keys]
    cut = df.repartitionByRange(segments, *by_group, *order).withColumn(_SEGMENT, F.spark_partition_id())
    # range borders come from a sample, so a second run may cut elsewhere: write the cut down
    return Ordered(scratch_table(cut, "cut"), keys, order, segmented=True)


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "ranking", **options) -> DataFrame:
    """Number the rows of each group from 1 in the given order; options as for :func:`ordered`."""
    return ordered(df, keys, order, **options).scan(**{name: row_number()}).rows


def _carried(name: str) -> str:
    return f"__carried_{name}"


def _local(scan: Scan, window) -> Column:
    so_far = window.rowsBetween(W.unboundedPreceding, -1 if scan.before_row else W.currentRow)
    match scan.kind:
        case "sum":
            return F.sum(scan.value).over(so_far)
        case "count":
            return F.count(F.when(scan.value, 1)).over(so_far)
        case "max":
            return F.max(scan.value).over(so_far)
        case "previous":
            return F.lag(scan.value).over(window)
        case "following":
            return F.lead(scan.value).over(window)
    raise ValueError(scan.kind)


def _summary(scan: Scan) -> Column:
    """What a segment tells the others."""
    match scan.kind:
        case "sum":
            return F.sum(scan.value)
        case "count":
            return F.count(F.when(scan.value, 1))
        case "max":
            return F.max(scan.value)
        case "previous":
            return F.max_by(scan.value, F.col(_PLACE))
        case _:
            return F.min_by(scan.value, F.col(_PLACE))


def _carry(name: str, scan: Scan, across, earlier) -> Column:
    """What the other segments of the group add up to."""
    match scan.kind:
        case "sum" | "count":
            return F.sum(name).over(earlier)
        case "max":
            return F.max(name).over(earlier)
        case "previous":
            return F.lag(name).over(across)
        case _:
            return F.lead(name).over(across)


def _combined(name: str, scan: Scan) -> Column:
    own, carried = F.col(name), F.col(_carried(name))
    match scan.kind:
        case "sum":
            return F.coalesce(own + carried, own, carried)
        case "count":
            return own + F.coalesce(carried, F.lit(0))
        case "max":
            return F.greatest(own, carried)
        case "previous":
            return F.when(F.col(_PLACE) == 1, carried).otherwise(own)
        case _:
            return F.when(F.col(_LAST), carried).otherwise(own)
