"""Late labels in the state store: equal to batch, restarts, and what a micro-batch touches."""

import json
import os
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from learnlog.operators import history as h
from learnlog.operators.joins import join_dim
from learnlog.session import scratch_path
from learnlog.sources import fixtures as fx
from learnlog.streaming import late_state as S

from conftest import SMOKE_SF

COLS = ["row_id", "answered_correctly_sum_u", "count_u", "part_sum_u", "part_count_u", "first_time"]


def expected(spark, rows, step=1):
    lg = fx.interactions(spark, SMOKE_SF).withColumn("task_container_id", (F.floor(F.col("row_id") / rows) * step).cast("long"))
    q = join_dim(lg.filter("content_type_id = 0"), fx.questions(spark, SMOKE_SF).select("question_id", "part"), "content_id", "question_id")
    return h.add_user_feats(q, grain="container")


def put(rows, folder, k):
    """A file of the source; files are taken by their time."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{k:03d}.parquet"
    pq.write_table(rows.toArrow(), path)
    os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    return path


def test_equal_to_container_grain_history_with_content_columns(spark):
    base = scratch_path(spark, f"t-state-{uuid.uuid4().hex}")
    lg, qd = fx.interactions(spark, SMOKE_SF), fx.questions(spark, SMOKE_SF)
    content = S.content_columns(lg.filter("content_type_id = 0"), qd).cache()
    got = S.run_late_labels_in_state(spark, fx.test_batches(spark, SMOKE_SF, 200), qd, base, content)
    extra = [c for c in content.columns if c != "content_id"]
    assert {"answered_correctly_avg_c", "answered_correctly_std_c", "PCA_0", "PCA_3", "PCA_4"} <= set(extra)
    want = expected(spark, 200).select(*COLS, "content_id").join(content, "content_id", "left")
    key = lambda r: r["row_id"]
    assert sorted(got.select(*COLS, *extra).collect(), key=key) == sorted(want.select(*COLS, *extra).collect(), key=key)


def test_restart_after_a_crash(spark, tmp_path):
    """Files of two, three, one and two batches with gaps in their numbers; one can't be read at first."""
    folder, base = str(tmp_path / "in"), str(tmp_path)
    served = S.positioned(fx.test_batches(spark, SMOKE_SF, 100).withColumn("group_num", F.col("group_num") * 3)).cache()
    groups = sorted(r["group_num"] for r in served.select("group_num").distinct().collect())
    at, files = 0, []
    for n in (2, 3, 1, len(groups)):
        files.append(served.where(F.col("group_num").isin(groups[at:at + n])))
        at += n
    for k in (0, 1):
        put(files[k], folder, k)
    bad = put(files[2], folder, 2)
    size = os.path.getsize(bad)
    with open(bad, "wb") as out:
        out.write(b"\0" * size)
    os.utime(bad, (1_700_000_002, 1_700_000_002))

    def run():
        return S.start_late_labels(spark, folder, served.schema, fx.questions(spark, SMOKE_SF), base, files_per_trigger=1)

    with pytest.raises(StreamingQueryException):
        run().awaitTermination()
    put(files[2], folder, 2)
    put(files[3], folder, 3)
    run().awaitTermination()
    run().awaitTermination()                # nothing new: nothing twice
    got = sorted(spark.read.parquet(f"{base}/out").select(*COLS).collect())
    assert got == sorted(expected(spark, 100, 3).select(*COLS).collect())


def test_a_micro_batch_touches_only_its_own_users(spark, tmp_path):
    """Ten files of one batch each: what an epoch reads and updates doesn't grow with the epochs before it."""
    served = S.positioned(fx.test_batches(spark, SMOKE_SF, 100)).cache()
    folder = str(tmp_path / "in")
    groups = sorted(r["group_num"] for r in served.select("group_num").distinct().collect())
    for k, g in enumerate(groups):
        put(served.where(F.col("group_num") == g), folder, k)
    query = S.start_late_labels(spark, folder, served.schema, fx.questions(spark, SMOKE_SF), str(tmp_path), files_per_trigger=1)
    query.awaitTermination()
    progress = [json.loads(p.json) for p in query.recentProgress]
    rows = {r["group_num"]: r["n"] for r in served.groupBy("group_num").agg(F.count("*").alias("n")).collect()}
    epochs = [p for p in progress if p["numInputRows"]]
    assert [p["numInputRows"] for p in epochs] == [rows[g] for g in groups]
    updated = [sum(s["numRowsUpdated"] for s in p["stateOperators"]) for p in epochs]
    total = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in epochs]
    # per answered row at most a total, a part and a content, and per row an entry of the waiting list (and its count)
    assert max(updated) <= 3 * 100 + 100 + 4
    assert total[-1] > 2 * max(updated)
    got = sorted(spark.read.parquet(f"{tmp_path}/out").select(*COLS).collect())
    assert got == sorted(expected(spark, 100).select(*COLS).collect())


def test_the_callers_session_stays_as_it_is(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    assert S.streaming_session(spark).conf.get(name) == S.ROCKSDB
    assert spark.conf.get(name, None) == before
