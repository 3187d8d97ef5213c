"""Steps whose disk, memory or time grew faster than the log: what they write, sort and compute."""

import os
import random
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from learnlog.registry import QUERIES, load_all

load_all()
TYPES = ("view", "purchase", "click", "error", "signup")


def tables(folder, n, users=30, parts=400, seed=3):
    """A log of ``n`` events and a part table under ``folder``; returns the events."""
    rng, t0 = random.Random(seed), datetime(2024, 1, 1)
    rows = [{"event_id": i, "ts": t0 + timedelta(seconds=60 * i), "user_id": rng.randrange(users), "event_type": rng.choice(TYPES),
             "value": round(rng.random() * 100, 2), "props": f'{{"k": {rng.randrange(100)}}}'} for i in range(n)]
    pq.write_table(pa.Table.from_pylist(rows, pa.schema([
        ("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()), ("event_type", pa.string()),
        ("value", pa.float64()), ("props", pa.string())])), f"{folder}/events.parquet")
    part = [{"p_partkey": k, "p_type": rng.choice(("PROMO", "SMALL", "LARGE", "ECONOMY")), "p_size": rng.randrange(1, 51)} for k in range(parts)]
    pq.write_table(pa.Table.from_pylist(part, pa.schema([
        ("p_partkey", pa.int64()), ("p_type", pa.string()), ("p_size", pa.int32())])), f"{folder}/part.parquet")
    return rows


def lists_of(rows, batch_rows=1000):
    """(answers, responses) of each batch as texts."""
    out = {}
    for r in rows:
        a, u = out.setdefault(r["event_id"] // batch_rows, ([], []))
        view = r["event_type"] == "view"
        a.append(-1 if view else int(r["event_type"] in ("purchase", "click")))
        u.append(-1 if view else r["event_id"] % 4)
    return {g: tuple("[" + ", ".join(map(str, x)) + "]" for x in v) for g, v in out.items()}


def test_scanned_batches_hold_the_lists_of_a_batch_once_on_disk(spark, tmp_path):
    rows = [r for r in tables(str(tmp_path), 5000) if not 2000 <= r["event_id"] < 3000]      # batch 2 is missing
    pq.write_table(pq.read_table(f"{tmp_path}/events.parquet").filter(
        (pa.compute.field("event_id") < 2000) | (pa.compute.field("event_id") >= 3000)), f"{tmp_path}/events.parquet")
    lists, before = lists_of(rows), {0: ("[]", "[]")}
    before |= {g: lists[p] for p, g in ((0, 1), (1, 3), (3, 4))}
    out = QUERIES["scan_test_batches"](spark, str(tmp_path))
    got = {r["row_id"]: (r["prior_group_answers_correct"], r["prior_group_responses"]) for r in out.collect()}
    assert got == {r["event_id"]: before[r["event_id"] // 1000] for r in rows}
    text = sum(len(x) for v in got.values() for x in v)
    disk = sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in out.inputFiles())
    assert disk * 10 < text


def test_streamed_batches_are_dealt_without_their_lists_on_every_row(spark, tmp_path, monkeypatch):
    from learnlog.plans import q_streaming as qs

    rows, dealt = tables(str(tmp_path), 3000), []
    deal = type(spark.range(1)).repartitionByRange
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda self, *a: dealt.append(self.columns) or deal(self, *a))
    stream = qs.batch_stream(spark, str(tmp_path), str(tmp_path / "base"))
    assert not any({"row_id", "prior_group_answers_correct"} <= set(c) for c in dealt)
    written = spark.read.schema(stream.schema).parquet(str(tmp_path / "base" / "in"))
    lists = {-1: ("[]", "[]")} | lists_of(rows)
    assert {r["row_id"]: (r["prior_group_answers_correct"], r["prior_group_responses"]) for r in written.collect()} == {
        r["event_id"]: lists[r["event_id"] // 1000 - 1] for r in rows}


def counted(spark, n):
    """A table whose column ``x`` is computed by a counting function, and the count."""
    calls = spark.sparkContext.accumulator(0)

    def f(k):
        calls.add(1)
        return float(k % 17)

    return spark.range(n).withColumn("x", F.udf(f, "double")("id")), calls


def test_training_computes_its_rows_once(spark):
    from learnlog.operators.model import GBTConfig, train_gbt

    df, calls = counted(spark, 200)
    df = df.select("x", (F.col("id") % 3).alias("flag"), (F.col("x") > 8).cast("int").alias("answered_correctly"), (F.col("id") % 5 == 0).alias("is_valid"))
    train_gbt(df, ["x", "flag"], cfg=GBTConfig(max_iter=2, max_depth=2), categorical=["flag"])
    assert calls.value <= 2 * 200          # x itself, and where the label uses it


def test_the_models_table_is_computed_once(spark, monkeypatch):
    from learnlog.plans import q_model

    df, calls = counted(spark, 50)
    monkeypatch.setattr(q_model, "_MODELS", {})
    monkeypatch.setattr(q_model, "model_table", lambda *_: df)
    monkeypatch.setattr(q_model.md, "train_gbt", lambda table, *_, **__: table.agg(F.sum("x")).first())
    model, table = q_model.fitted(spark, "nowhere")
    assert table.agg(F.sum("x")).first() == model and table.count() == 50
    assert calls.value == 50


def test_tasks_of_lecture_history_go_by_rows(spark, tmp_path, monkeypatch):
    from learnlog.operators import prefix

    tables(str(tmp_path), 4000, users=200)
    want = sorted(map(str, QUERIES["lecture_history"](spark, str(tmp_path)).collect()))
    monkeypatch.setattr(prefix, "SPREAD_ROWS", 200)
    for name in ("lecture_history", "plan_b_features", "num_tags_match", "asof_prior_match"):
        out = QUERIES[name](spark, str(tmp_path))
        if name == "lecture_history":
            assert sorted(map(str, out.collect())) == want
            assert out.select(F.spark_partition_id().alias("p")).distinct().count() >= 15
        assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()


def test_positions_are_found_without_the_lists(spark, tmp_path, monkeypatch):
    from learnlog.sources import fixtures as fx
    from learnlog.streaming import late_state as S

    rows, ran, plain = tables(str(tmp_path), 2500), [], S.running
    monkeypatch.setattr(S, "running", lambda df, *a, **k: ran.append(df.columns) or plain(df, *a, **k))
    got = {r["row_id"]: r for r in S.positioned(fx.test_batches(spark, str(tmp_path))).collect()}
    assert ran and not any("prior_group_answers_correct" in c for c in ran)
    lists = {-1: ("[]", "[]")} | lists_of(rows)
    for r in rows:
        g, pos = divmod(r["event_id"], 1000)
        x = got.pop(r["event_id"])
        assert (x["group_num"], x["pos"], x["answers"], x["answers_of"]) == (
            g, pos, lists[g - 1][0] if pos == 0 else None, g - 1 if pos == 0 and g else None)
    assert not got
