"""Tables bucketed by user: same results, and no exchange."""

import os
import uuid

from pyspark.sql import functions as F

from learnlog.operators import history as h
from learnlog.operators import state as stt
from learnlog.plans.common import question_rows
from learnlog.plans.q_state import FROZEN_COLS, train_valid
from learnlog.session import scratch_path
from learnlog.sources import io

from conftest import SMOKE_SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_and_joins_on_the_user_need_no_exchange(spark):
    name, path = f"t_{uuid.uuid4().hex}", scratch_path(spark, f"t-{uuid.uuid4().hex}")
    train, valid = train_valid(spark, SMOKE_SF)
    rows = io.write_bucketed(question_rows(spark, SMOKE_SF), f"{name}_rows", f"{path}/rows", order=("timestamp", "row_id"), buckets=6)
    assert io.buckets_of(spark, f"{name}_rows") == 6
    cols = ["row_id", "answered_correctly_sum_u", "count_u", "part_sum_u", "part_count_u", "first_time"]
    feats = h.add_user_feats(rows)
    assert "Exchange" not in plan(feats) and "Window" in plan(feats)
    assert sorted(feats.select(*cols).collect()) == sorted(h.add_user_feats(question_rows(spark, SMOKE_SF)).select(*cols).collect())
    held = io.write_bucketed(valid, f"{name}_valid", f"{path}/valid", order=("timestamp", "row_id"), buckets=6)
    stt.save_state_bucketed(stt.build_state(train), name, f"{path}/state", 6)
    state = stt.load_state_bucketed(spark, name)
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    spark.conf.set(key, "false")
    try:
        out = stt.apply_bucketed_state(held, state)
        assert "Exchange" not in plan(out) and plan(out).count("SortMergeJoin") == 3
        got = sorted(out.select(*FROZEN_COLS).collect())
    finally:
        spark.conf.unset(key)
    assert got == sorted(stt.apply_frozen_state(valid, stt.build_state(train)).select(*FROZEN_COLS).collect())
    for t in ("rows", "valid", "user", "user_part", "user_content"):
        spark.sql(f"DROP TABLE {name}_{t}")


def test_one_sorted_file_per_bucket(spark):
    name, path = f"t_{uuid.uuid4().hex}", scratch_path(spark, f"t-{uuid.uuid4().hex}")
    df = spark.range(1000).select((F.col("id") % 37).alias("user_id"), (F.col("id") * 7 % 1000).alias("row_id"))
    io.write_bucketed(df, name, path, order=("row_id",), buckets=4)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) == 4
    for f in files:
        rows = [tuple(r) for r in spark.read.parquet(f"{path}/{f}").collect()]
        assert rows == sorted(rows)
    spark.sql(f"DROP TABLE {name}")
