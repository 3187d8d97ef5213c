"""Exact quantiles without gathering a column into one buffer: sketch, then refine.

``percentile`` keeps every distinct value of a group in one aggregation
buffer, so a whole-column quantile would sit in one task. Here:

1. one pass of mergeable KLL sketches, one per column, gives the number of
   values and a bracket around every wanted rank, wider than the sketch's error;
2. a second pass counts the values between the brackets and keeps the value
   counts inside them: of a column that is the sketch's error times the number
   of ranks, not all its values;
3. inside a bracket a running count finds the wanted ranks.

The counts tell whether a wanted rank lies in its bracket. A sketch errs beyond
its bound now and then; the brackets are then made wider and step 2 runs again,
so results are exact, whatever the sketch says.

NaN is no number and is ignored like NULL. Interpolation is linear at position
p * (N - 1), as ``quantile_cont`` and Spark's ``percentile`` do.
"""

from __future__ import annotations

import math
import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.prefix import ROWS_PER_TASK, Agg, running
from ..session import delete_path, scratch_path

#: Least size of a sketch, and its size per wanted quantile (KLL's k).
SKETCH, SKETCH_PER_RANK, SKETCH_MOST = 2048, 64, 65535


def rank_error(k: int) -> float:
    """Share of the values by which a sketch's rank is off, with a margin on KLL's published bound."""
    return 1.3 * 2.296 / k ** 0.9021


def _search(c: Column, cuts: list[float], right: bool) -> Column:
    """Number of cuts below ``c`` (``right``: or equal), by a binary search in one expression."""
    def part(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        over = c >= F.lit(cuts[mid]) if right else c > F.lit(cuts[mid])
        return F.when(over, part(mid + 1, hi)).otherwise(part(lo, mid))
    return part(0, len(cuts))


def _merged(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Disjoint brackets, in order."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def column_quantiles(df: DataFrame, cols: dict[str, Column], probs: Sequence[float],
                     rows_per_task: int | None = None, k: int | None = None) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns in two passes, one list per column.

    What comes to the driver is, per column and prob, a bracket, two counts and
    at most two values.
    """
    k = k or min(SKETCH_MOST, max(SKETCH, SKETCH_PER_RANK * len(probs)))
    long = df.select(*[c.cast("double").alias(n) for n, c in cols.items()]).unpivot([], list(cols), "_col", "_x")
    long = long.where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    total, bracket, error = {}, {}, rank_error(k)
    sketches = long.groupBy("_col").agg(F.count("*").alias("n"), F.kll_sketch_agg_double("_x", F.lit(k)).alias("s"), F.min("_x").alias("least"), F.max("_x").alias("most"))
    wide = [max(0.0, p - error) for p in probs] + [min(1.0, p + error) for p in probs]
    if wide:
        sketches = sketches.withColumn("at", F.kll_sketch_get_quantile_double("s", F.array(*map(F.lit, wide))))
    for r in sketches.drop("s").collect():
        total[r["_col"]] = r["n"]
        bracket[r["_col"]] = {p: (r["least"] if p <= error else r["at"][i], r["most"] if p >= 1 - error else r["at"][len(probs) + i]) for i, p in enumerate(probs)}
    positions = {c: {p: p * (n - 1) for p in probs} for c, n in total.items()}
    wanted = {c: sorted({f(q) for q in at.values() for f in (math.floor, math.ceil)}) for c, at in positions.items()}
    found: dict[tuple[str, int], float] = {}
    while total:
        found |= _refined(long, {c: _merged(list(b.values())) for c, b in bracket.items()}, wanted, rows_per_task)
        missing = {c: [q for q in ranks if (c, q) not in found] for c, ranks in wanted.items()}
        wanted = {c: ranks for c, ranks in missing.items() if ranks}
        if not wanted:
            break
        # beyond the sketch's bound: everything between the brackets of these columns
        bracket = {c: {0.0: (-math.inf, math.inf)} for c in wanted}

    def value(c: str, q: float) -> float:
        a, b = found[c, math.floor(q)], found[c, math.ceil(q)]
        return a if a == b else a + (q - math.floor(q)) * (b - a)

    return {c: [value(c, positions[c][p]) for p in probs] if c in total else [None for _ in probs] for c in cols}


def _refined(long: DataFrame, brackets: dict[str, list[tuple[float, float]]], wanted: dict[str, list[int]],
             rows_per_task: int | None) -> dict[tuple[str, int], float]:
    """Values at those of the wanted ranks that lie in a bracket."""
    spark, x = long.sparkSession, F.col("_x")
    # spaces and brackets are numbered from the left: bracket i is 2 i + 1
    place = None
    for c, b in brackets.items():
        own = _search(x, [lo for lo, _ in b], True) + _search(x, [hi for _, hi in b], False)
        place = F.when(F.col("_col") == c, own) if place is None else place.when(F.col("_col") == c, own)
    path = scratch_path(spark, f"brackets-{uuid.uuid4().hex}")
    (long.where(F.col("_col").isin(*brackets)).withColumn("_at", place)
     .groupBy("_col", "_at", F.when(F.col("_at") % 2 == 1, x).alias("_x")).agg(F.count("*").alias("_n")).write.parquet(path))
    counts = spark.read.parquet(path)
    sizes = {(r["_col"], r["_at"]): (r["n"], r["rows"]) for r in counts.groupBy("_col", "_at").agg(F.sum("_n").alias("n"), F.count("*").alias("rows")).collect()}
    ranks = []
    for c, qs in wanted.items():
        below = 0
        for at in range(2 * len(brackets[c]) + 1):
            n = sizes.get((c, at), (0, 0))[0]
            ranks += [(c, at, q, q - below) for q in qs if at % 2 and below <= q < below + n]
            below += n
    if not ranks:
        delete_path(spark, path)
        return {}
    inside = counts.where(F.col("_at") % 2 == 1)
    if max(rows for (_, at), (_, rows) in sizes.items() if at % 2) <= (rows_per_task or ROWS_PER_TASK):
        to = F.sum("_n").over(Window.partitionBy("_col", "_at").orderBy("_x"))
        inside = inside.withColumn("_to", to)
    else:
        inside = running(inside, ["_col", "_at"], [Agg("_to", "sum", F.col("_n"))], order=("_x",), inclusive=True, rows_per_task=rows_per_task)
    # two ranks per prob and column: a number set by the caller
    asked = spark.createDataFrame(ranks, "_col string, _at int, _rank long, _q long")
    hit = inside.join(F.broadcast(asked.groupBy("_col", "_at").agg(F.sort_array(F.collect_list(F.struct("_q", "_rank"))).alias("_asked"))), ["_col", "_at"])
    hit = hit.select("_col", "_x", F.explode(F.filter("_asked", lambda a: (a["_q"] < F.col("_to")) & (a["_q"] >= F.col("_to") - F.col("_n")))).alias("_hit"))
    out = {(r["_col"], r["_rank"]): r["_x"] for r in hit.select("_col", "_x", "_hit._rank").collect()}
    delete_path(spark, path)
    return out


def quantiles(df: DataFrame, x: str | Column, probs: Sequence[float],
              rows_per_task: int | None = None) -> list[float | None]:
    """Exact quantiles of ``x`` (NULL and NaN ignored), one per prob; None without values."""
    return column_quantiles(df, {"x": F.col(x) if isinstance(x, str) else x}, probs, rows_per_task)["x"]
