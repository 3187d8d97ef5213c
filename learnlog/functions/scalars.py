"""Scalar column functions (survey 2.8). All are built-in expressions, so they
stay inside whole-stage codegen."""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference's rate smoothing: questions seen fewer than 3
# times get 0.65; rates under 0.2 or over 0.95 with fewer than 21 answers are
# pulled to 0.2 / 0.95.
SMOOTH_MIN_COUNT, SMOOTH_DEFAULT = 3, 0.65
SMOOTH_LOW, SMOOTH_HIGH, SMOOTH_COUNT = 0.2, 0.95, 21
CONTAINER_CAP = 9999


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_tags_columns(tags: str | Column, n: int = 6, prefix: str = "tags") -> list[Column]:
    """'a b c' -> tags1..tagsN as numbers (NULL past the end or when not numeric)."""
    parts = F.split(_c(tags), " ")
    return [F.get(parts, i).try_cast("int").alias(f"{prefix}{i + 1}") for i in range(n)]


def to_numeric(x: str | Column, kind: str = "double") -> Column:
    """Text to number; bad values become NULL (``errors='coerce'``)."""
    return _c(x).try_cast(kind)


def one_hot(col: str, values: Iterable, prefix: str | None = None) -> list[Column]:
    """Dummy 0/1 columns ``{prefix}_{value}`` over a fixed list of values."""
    p = prefix or col
    return [(F.col(col) == F.lit(v)).cast("int").alias(f"{p}_{v}") for v in values]


def replace_value(x: str | Column, old, new) -> Column:
    c = _c(x)
    return F.when(c == F.lit(old), F.lit(new)).otherwise(c)


def log_clip(x: str | Column, low: float = 1.0) -> Column:
    """ln(max(x, low)); NULL stays NULL (fill first if needed)."""
    c = _c(x)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.ln(F.greatest(c.cast("double"), F.lit(float(low)))))


def fill_mean(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """NULL -> the column's mean (one scalar aggregate, used as a literal)."""
    cols = list(cols)
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(means[c]).cast("double"))
                           for c in cols})


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def fill_token(x: str | Column, token: str = "missing") -> Column:
    return F.coalesce(_c(x).cast("string"), F.lit(token))


def bool_to_int(x: str | Column, null_as=False) -> Column:
    """Flag -> 0/1, NULL -> ``null_as`` (D7: NULL is false)."""
    return F.coalesce(_c(x), F.lit(null_as)).cast("int")


def round_half_even(x: str | Column, digits: int) -> Column:
    """Half-even rounding through a decimal so both engines agree (D9)."""
    scale = 9 if digits > 2 else 6
    return F.bround(_c(x).cast(f"decimal(18,{scale})"), digits).cast("double")


def smooth_rate(rate: str | Column, count: str | Column) -> Column:
    """count < 3 -> 0.65; rate < 0.2 & count < 21 -> 0.2; rate > 0.95 &
    count < 21 -> 0.95 (first match wins, as the sequential masks do)."""
    r, n = _c(rate), _c(count)
    return (F.when(n < SMOOTH_MIN_COUNT, F.lit(SMOOTH_DEFAULT))
             .when((r < SMOOTH_LOW) & (n < SMOOTH_COUNT), F.lit(SMOOTH_LOW))
             .when((r > SMOOTH_HIGH) & (n < SMOOTH_COUNT), F.lit(SMOOTH_HIGH))
             .otherwise(r))


def cap_container(x: str | Column = "task_container_id", cap: int = CONTAINER_CAP) -> Column:
    return F.least(_c(x), F.lit(cap))


def shift_part(x: str | Column = "part") -> Column:
    return _c(x) - 1


def tag_dummies(tags: str | Column, vocabulary: Iterable[int], prefix: str = "tag") -> list[Column]:
    """Multi-hot columns, one per vocabulary tag."""
    from ..operators.lectures import parse_tags
    arr = parse_tags(tags)
    return [F.coalesce(F.array_contains(arr, F.lit(int(t))), F.lit(False)).cast("int").alias(f"{prefix}_{t}")
            for t in vocabulary]
