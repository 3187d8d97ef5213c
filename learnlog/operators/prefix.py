"""Running ("before this row") aggregates that stay parallel under key skew.

A running aggregate is a window over a key. Keys with at most
``rows_per_task`` rows (nearly all) are plain windows after one shuffle on the
key, which every family of a call shares. A key with more rows would put them
all into one task, so the rows of such *hot* keys are

1. range-partitioned by (key, order) and written as a table, with the number of
   the range as ``_chunk``: ranges follow the rows' counts, not the values, so
   neither a burst nor equal timestamps nor an outlier fill one of them;
2. summed up per (key, chunk), and the sums carried over a key's chunks (a row
   per chunk);
3. run inside (key, chunk), plus what the chunk carries in:

       prior(row) = carried(key, chunk) + running-within(key, chunk)(row)

Whether there are hot keys, and how many rows they have, is one aggregate over
the key columns. The hot keys themselves stay a DataFrame. Results never depend
on ``rows_per_task``.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

CHUNK = "_chunk"

# Rows of one key that a task may hold: a few hundred MB.
ROWS_PER_TASK = 4_000_000
# Rows of many keys that a task of plain windows takes, about (adaptive execution
# goes by shuffled bytes, which says little about sorted rows and their copies),
# and the number of tasks beyond which they take more.
SPREAD_ROWS, MOST_TASKS = 150_000, 40_000
# Types of an exact sum's terms and of the sum: one digit is left for a carried sum.
ADDEND, TOTAL = "decimal(27,18)", "decimal(37,18)"
# Ranges are drawn from a sample, so they are cut a little smaller than asked.
RANGE_SLACK = 1.5


@dataclass(frozen=True)
class Agg:
    """One running aggregate: ``kind`` is sum, count, max, exact, last or next.

    ``sum`` and ``count`` are of whole numbers. ``exact`` is the sum of numbers
    with fractions, of which 18 digits count: a decimal, the same whatever the
    ranges are, as sums of doubles are not.

    ``last`` is the value of the immediately preceding row and ``next`` that
    of the following row (a lag / lead that also crosses chunk borders); both
    need row grain.
    """

    name: str
    kind: str
    col: Column


@dataclass(frozen=True)
class Family:
    """Running aggregates over ``keys + sub_keys`` (see ``running_families``)."""

    aggs: tuple
    sub_keys: tuple = ()


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int | None = None) -> tuple[DataFrame, int]:
    """Keys with more than ``rows_per_task`` rows, and their rows in all (one
    aggregate over the key columns, one number to the driver)."""
    return _key_counts(df, keys, rows_per_task or ROWS_PER_TASK)[:2]


def _key_counts(df: DataFrame, keys: Sequence[str], limit: int) -> tuple[DataFrame, int, int]:
    """``hot_keys``, and the rows of all keys."""
    n = F.col("_n")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    many, every = counts.agg(F.sum(F.when(n > limit, n)), F.sum(n)).first()
    return counts.where(n > limit).select(*keys), many or 0, every or 0


def spread(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df`` partitioned by ``keys``. More than ``SPREAD_ROWS`` rows get tasks by
    their number, so that a task's share doesn't grow with the table; the same
    number of rows gets the same partitioning, which is not made twice."""
    n = math.ceil(rows / SPREAD_ROWS)
    if n <= 1:
        return df.repartition(*keys)
    return df.repartition(min(max(n, df.sparkSession.sparkContext.defaultParallelism), MOST_TASKS), *keys)


def in_ranges(rows: DataFrame, by: Sequence[str], total: int, rows_per_task: int | None = None) -> DataFrame:
    """``rows`` as a stored table with the number of its range in ``by`` order
    as ``_chunk``; ranges have about ``rows_per_task`` rows or fewer. Stored,
    so that every later read sees the same ranges."""
    n = math.ceil(total / (rows_per_task or ROWS_PER_TASK) * RANGE_SLACK) + 1
    return stored(rows.repartitionByRange(n, *by).withColumn(CHUNK, F.spark_partition_id()), "ranges")


def _summary(a: Agg, c: Column, order: Sequence[str]) -> Column:
    if a.kind in ("last", "next"):
        return (F.max_by if a.kind == "last" else F.min_by)(c, F.struct(*order))
    return {"sum": F.sum, "exact": F.sum, "count": F.count, "max": F.max}[a.kind](c)


def _carried(a: Agg, t: Column, over_chunks) -> Column:
    if a.kind == "last":
        return F.lag(t).over(over_chunks)
    if a.kind == "next":
        return F.lead(t).over(over_chunks)
    total = F.max if a.kind == "max" else F.sum
    return total(t).over(over_chunks.rowsBetween(Window.unboundedPreceding, -1))


def _within(a: Agg, c: Column, ordered, frame, inclusive: bool) -> Column:
    """The aggregate over the rows of ``frame`` (NULL or 0 where there is none)."""
    if a.kind in ("last", "next"):
        if inclusive and a.kind == "last":
            return c
        return (F.lag if a.kind == "last" else F.lead)(c).over(ordered)
    if a.kind == "max":
        return F.max(c).over(frame)
    if a.kind == "exact":
        return F.coalesce(F.sum(c).over(frame), F.lit(0)).cast(TOTAL)
    return F.coalesce((F.sum if a.kind == "sum" else F.count)(c).over(frame), F.lit(0)).cast("long")


def _frames(keys: Sequence[str], order: Sequence[str], container: str | None, inclusive: bool):
    base = Window.partitionBy(*keys) if keys else Window.partitionBy()
    end = 0 if inclusive else -1
    if container is not None:
        ordered = base.orderBy(container)
        return ordered, ordered.rangeBetween(Window.unboundedPreceding, end)
    ordered = base.orderBy(*order)
    return ordered, ordered.rowsBetween(Window.unboundedPreceding, end)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal keys, NULL equal to NULL; the left side's keys stay."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    cond = functools.reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in on])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in on])


def _plain(df: DataFrame, keys, families, order, container, inclusive, arranged) -> DataFrame:
    # the windows over the keys alone come first: whatever partitioning they have
    # or get serves those over more keys, so nothing is shuffled twice
    plain = sorted(families, key=lambda f: len(f.sub_keys))
    rows = df if arranged or not plain[0].sub_keys else df.repartition(*keys)
    for fam in plain:
        ordered, frame = _frames([*keys, *fam.sub_keys], order, container, inclusive)
        rows = rows.withColumns({a.name: _within(a, F.col(f"_m_{a.name}"), ordered, frame, inclusive) for a in fam.aggs})
    return rows


def _ranged(df: DataFrame, keys, families, order, inclusive, total, limit) -> DataFrame:
    """Row grain over hot keys: in chunks, plus what each chunk carries in."""
    rows = in_ranges(df, [*keys, *order], total, limit)
    out = rows
    for fam in families:
        by = [*keys, *fam.sub_keys]
        totals = rows.groupBy(*by, CHUNK).agg(*[_summary(a, F.col(f"_m_{a.name}"), order).alias(f"_o_{a.name}") for a in fam.aggs])
        over_chunks = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(CHUNK)
        carried = totals.select(*by, CHUNK, *[_carried(a, F.col(f"_o_{a.name}"), over_chunks).alias(f"_o_{a.name}") for a in fam.aggs])
        out = null_safe_join(out, carried, [*by, CHUNK])
    cols = {}
    for fam in families:
        ordered, frame = _frames([*keys, *fam.sub_keys, CHUNK], order, None, inclusive)
        for a in fam.aggs:
            c, o = F.col(f"_m_{a.name}"), F.col(f"_o_{a.name}")
            inner = _within(a, c, ordered, frame, inclusive)
            if a.kind in ("sum", "count"):
                cols[a.name] = (inner + F.coalesce(o, F.lit(0))).cast("long")
            elif a.kind == "exact":
                cols[a.name] = (inner + F.coalesce(o, F.lit(0)).cast(TOTAL)).cast(TOTAL)
            elif a.kind == "max":
                cols[a.name] = F.greatest(o, inner)
            elif inclusive and a.kind == "last":
                cols[a.name] = inner
            else:
                edge = (F.lag if a.kind == "last" else F.lead)(F.lit(1)).over(ordered).isNull()
                cols[a.name] = F.when(edge, o).otherwise(inner)
    return out.withColumns(cols).drop(CHUNK, *[f"_o_{a.name}" for f in families for a in f.aggs])


def _by_container(df: DataFrame, keys, families, container, inclusive, limit) -> DataFrame:
    """Container grain over hot keys: a container's rows are summed up first,
    so that no window ever holds the rows of one container."""
    rows = out = stored(df, "containers")
    for fam in families:
        by = [*keys, *fam.sub_keys]
        per = rows.groupBy(*by, container).agg(*[_summary(a, F.col(f"_m_{a.name}"), ()).alias(f"_t_{a.name}") for a in fam.aggs])
        over = Family(tuple(Agg(a.name, a.kind if a.kind in ("max", "exact") else "sum", F.col(f"_t_{a.name}")) for a in fam.aggs))
        run = running_families(per, by, [over], order=(container,), inclusive=inclusive, rows_per_task=limit)
        out = null_safe_join(out, run.select(*by, container, *[a.name for a in fam.aggs]), [*by, container])
    return out


def running(df: DataFrame, keys: Sequence[str], aggs: Iterable[Agg], **kw) -> DataFrame:
    """``running_families`` with one family."""
    return running_families(df, keys, [Family(tuple(aggs))], **kw)


def running_families(df: DataFrame, keys: Sequence[str], families: Sequence[Family], *,
                     order: Sequence[str] = ("timestamp", "row_id"), container: str | None = None,
                     inclusive: bool = False, rows_per_task: int | None = None, arranged: bool = False,
                     count_on: tuple[DataFrame, int] | None = None, spread_out: bool = False) -> DataFrame:
    """Add one column per ``Agg`` holding its value over earlier rows.

    Row grain (``container=None``): earlier = before in ``order`` within the
    key; with ``inclusive`` the current row counts too. Container grain: earlier
    = rows of the key whose ``container`` is smaller (a RANGE frame), so rows of
    one container never see each other; with ``inclusive`` the current
    container counts. Families over ``keys + sub_keys`` share the shuffle on
    ``keys``; ``arranged`` says that ``df`` is already partitioned by them.
    ``count_on`` is what the rows of ``df`` were made of, and about how many rows
    of it one row became: hot keys are looked for there, before joins and copies.
    ``spread_out`` partitions rows that have no partitioning yet by ``spread``.
    """
    keys = list(keys)
    aggs = [a for f in families for a in f.aggs]
    if container is not None and any(a.kind in ("last", "next") for a in aggs):
        raise ValueError("'last' and 'next' need row grain")
    limit = rows_per_task or ROWS_PER_TASK
    measured = df.withColumns({f"_m_{a.name}": a.col.cast(ADDEND) if a.kind == "exact" else a.col for a in aggs})
    counted, copies = count_on or (measured, 1)
    hot, total, every = _key_counts(counted, keys, max(1, limit // copies))
    total *= copies
    if not total:
        if spread_out and every > SPREAD_ROWS:
            measured, arranged = spread(measured, keys, every), True
        res = _plain(measured, keys, families, order, container, inclusive, arranged)
        return res.drop(*[f"_m_{a.name}" for a in aggs])
    many = null_safe_join(measured, hot, keys, "left_semi") if keys else measured
    if container is None:
        res = _ranged(many, keys, families, order, inclusive, total, limit)
    else:
        res = _by_container(many, keys, families, container, inclusive, limit)
    if keys:
        few = null_safe_join(measured, hot, keys, "left_anti")
        res = _plain(few, keys, families, order, container, inclusive, False).unionByName(res)
    return res.drop(*[f"_m_{a.name}" for a in aggs])
