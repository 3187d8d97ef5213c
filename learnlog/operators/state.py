"""History state carried between data sets (survey 2.1 state rows, 2.5).

State is three tables: per user (sum, count), per (user, part) (sum,
count) and the distinct (user, content) pairs seen. They are what the
reference keeps in dicts; here they are DataFrames written as parquet under
the shared checkpoint folder, so a lost executor or a restarted job re-reads
them instead of recomputing the history.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.io import write_bucketed
from .history import part_key, ratio
from .prefix import Agg, Family, hot_keys, null_safe_join, running_families

LABEL = "answered_correctly"


@dataclass
class State:
    user: DataFrame          # user_id, answered_correctly_sum_u, count_u
    user_part: DataFrame     # user_id, part_k, part_sum_u, part_count_u
    user_content: DataFrame  # user_id, content_id


def build_state(q: DataFrame, label: str = LABEL) -> State:
    """State after the labelled question rows ``q`` (needs part)."""
    y = F.col(label)
    user = q.groupBy("user_id").agg(F.sum(y).cast("long").alias("answered_correctly_sum_u"),
                                    F.count(F.lit(1)).alias("count_u"))
    up = (q.withColumn("part_k", part_key()).groupBy("user_id", "part_k")
            .agg(F.sum(y).cast("long").alias("part_sum_u"), F.count(F.lit(1)).alias("part_count_u")))
    uc = q.select("user_id", "content_id").distinct()
    return State(user, up, uc)


def merge_states(*states: State) -> State:
    """The states of disjoint rows as one (D2: sum, count, part and content together)."""
    def union(name: str) -> DataFrame:
        return functools.reduce(DataFrame.unionByName, [getattr(s, name) for s in states])

    user = (union("user").groupBy("user_id")
            .agg(F.sum("answered_correctly_sum_u").cast("long").alias("answered_correctly_sum_u"),
                 F.sum("count_u").cast("long").alias("count_u")))
    up = (union("user_part").groupBy("user_id", "part_k")
          .agg(F.sum("part_sum_u").cast("long").alias("part_sum_u"),
               F.sum("part_count_u").cast("long").alias("part_count_u")))
    return State(user, up, union("user_content").distinct())


def update_state(state: State, q: DataFrame, label: str = LABEL) -> State:
    """Fold newly answered question rows into the state."""
    return merge_states(state, build_state(q, label))


def save_state(state: State, path: str) -> None:
    state.user.write.mode("overwrite").parquet(f"{path}/user")
    state.user_part.write.mode("overwrite").parquet(f"{path}/user_part")
    state.user_content.write.mode("overwrite").parquet(f"{path}/user_content")


def load_state(spark: SparkSession, path: str) -> State:
    return State(spark.read.parquet(f"{path}/user"), spark.read.parquet(f"{path}/user_part"),
                 spark.read.parquet(f"{path}/user_content"))


def apply_frozen_state(rows: DataFrame, state: State, rows_per_task: int | None = None) -> DataFrame:
    """Features for new rows from the state at the cut-off, with no update
    inside ``rows`` (the reference's "without update" pass). Unknown users
    get 0 counts; first_time tests content (D1).

    The rows and the three state tables are put together and shuffled once, on
    the user; windows over the user, the (user, part) and the (user, content)
    then bring a state entry to its rows. Users with more rows than a task
    should hold are looked up by joins instead, which adaptive execution splits.
    """
    rows = rows.withColumn("part_k", part_key())
    hot, total = hot_keys(rows, ["user_id"], rows_per_task)
    if not total:
        return _state_feats(_looked_up(rows, state))
    few = _looked_up(null_safe_join(rows, hot, ["user_id"], "left_anti"), state)
    many = (null_safe_join(rows, hot, ["user_id"], "left_semi").join(state.user, "user_id", "left")
            .join(state.user_part, ["user_id", "part_k"], "left")
            .join(state.user_content.withColumn("_seen", F.lit(1)), ["user_id", "content_id"], "left"))
    return _state_feats(few.unionByName(many))


def save_state_bucketed(state: State, name: str, path: str, buckets: int) -> State:
    """The state as three tables ``name_user``, ``name_user_part`` and
    ``name_user_content``, bucketed by user and sorted by their keys."""
    return State(
        write_bucketed(state.user, f"{name}_user", f"{path}/user", buckets=buckets),
        write_bucketed(state.user_part, f"{name}_user_part", f"{path}/user_part", order=("part_k",), buckets=buckets),
        write_bucketed(state.user_content, f"{name}_user_content", f"{path}/user_content", order=("content_id",), buckets=buckets))


def load_state_bucketed(spark: SparkSession, name: str) -> State:
    return State(*(spark.table(f"{name}_{t}") for t in ("user", "user_part", "user_content")))


def apply_bucketed_state(rows: DataFrame, state: State) -> DataFrame:
    """``apply_frozen_state`` of a bucketed table of rows and a state with as
    many buckets: joins of bucket with bucket, no exchange. A user's rows are
    in one bucket, so this is for logs whose users fit a task."""
    rows = rows.withColumn("part_k", part_key())
    seen = state.user_content.withColumn("_seen", F.lit(1))
    out = (rows.join(state.user.hint("merge"), "user_id", "left").join(seen.hint("merge"), ["user_id", "content_id"], "left")
           .join(state.user_part.hint("merge"), ["user_id", "part_k"], "left"))
    return _state_feats(out)


_ENTRY = ("answered_correctly_sum_u", "count_u", "part_sum_u", "part_count_u", "_seen")


def _looked_up(rows: DataFrame, state: State) -> DataFrame:
    """``rows`` with the entries of their user, (user, part) and (user, content), NULL where there is none."""
    both = rows.withColumn("_row", F.lit(True))
    for table in (state.user, state.user_part, state.user_content.withColumn("_seen", F.lit(1))):
        both = both.unionByName(table, allowMissingColumns=True)
    both = both.repartition("user_id")

    def entry(c: str, *keys: str):
        return F.max(c).over(Window.partitionBy("user_id", *keys)).alias(c)

    looked = both.withColumns({"answered_correctly_sum_u": entry("answered_correctly_sum_u"), "count_u": entry("count_u"),
                               "part_sum_u": entry("part_sum_u", "part_k"), "part_count_u": entry("part_count_u", "part_k"),
                               "_seen": entry("_seen", "content_id")})
    return looked.where("_row").drop("_row")


def _state_feats(out: DataFrame) -> DataFrame:
    out = out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in _ENTRY[:4]})
    return out.withColumns({
        "first_time": F.when(F.col("_seen").isNull(), 1).otherwise(0),
        "answered_correctly_avg_u": ratio("answered_correctly_sum_u", "count_u"),
        "part_avg_u": ratio("part_sum_u", "part_count_u"),
    }).drop("_seen", "part_k")


def add_user_feats_continued(train: DataFrame, valid: DataFrame, label: str = LABEL,
                             rows_per_task: int | None = None) -> DataFrame:
    """Features of ``valid`` rows with state updated row by row, continuing
    from all of ``train``: one running pass over the union ordered by
    (split, timestamp, row_id), then only valid rows are kept."""
    both = (train.withColumn("_split", F.lit(0)).unionByName(valid.withColumn("_split", F.lit(1)))
                 .withColumn("part_k", part_key()))
    order = ("_split", "timestamp", "row_id")
    y = F.col(label)
    out = running_families(both, ["user_id"], [
        Family((Agg("answered_correctly_sum_u", "sum", y), Agg("count_u", "count", F.lit(1)))),
        Family((Agg("part_sum_u", "sum", y), Agg("part_count_u", "count", F.lit(1))), ("part_k",)),
        Family((Agg("_seen", "count", F.lit(1)),), ("content_id",)),
    ], order=order, rows_per_task=rows_per_task)
    return (out.filter(F.col("_split") == 1)
               .withColumns({"first_time": (F.col("_seen") == 0).cast("int"),
                             "answered_correctly_avg_u": ratio("answered_correctly_sum_u", "count_u"),
                             "part_avg_u": ratio("part_sum_u", "part_count_u")})
               .drop("_split", "_seen", "part_k"))
