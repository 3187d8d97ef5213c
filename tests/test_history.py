"""History features against the pure-Python loop on random logs, with tiny
tasks so that carried values cross many ranges."""

import math

import pytest
from pyspark.sql import functions as F

from learnlog.operators import history as h
from learnlog.operators import lectures as lec
from learnlog.operators.joins import join_dim
from learnlog.schema import INTERACTIONS, LECTURES, QUESTIONS

from bruteforce import latest_lectures, lecture_loop, random_dims, random_log, user_feats


def _frames(spark, seed):
    rows = random_log(seed)
    qs, ls = random_dims(seed)
    log = spark.createDataFrame(rows, INTERACTIONS)
    return rows, qs, ls, log, spark.createDataFrame(qs, QUESTIONS), spark.createDataFrame(ls, LECTURES)


def _same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return a == b


@pytest.mark.parametrize("seed,rows_per_task", [(1, 5), (2, 1), (3, 1000), (4, 13)])
def test_add_user_feats_matches_row_loop(spark, seed, rows_per_task):
    rows, qs, _, log, qdf, _ = _frames(spark, seed)
    q = join_dim(log.filter("content_type_id = 0"), qdf.select("question_id", "part"), "content_id", "question_id")
    got = {r["row_id"]: r.asDict() for r in h.add_user_feats(q, rows_per_task=rows_per_task).collect()}
    part = {x["question_id"]: x["part"] for x in qs}
    qrows = [dict(r, part=part.get(r["content_id"])) for r in rows if r["content_type_id"] == 0]
    want = user_feats(qrows)
    assert set(got) == set(want)
    for rid, exp in want.items():
        for k, v in exp.items():
            assert _same(got[rid][k], v), (rid, k, got[rid][k], v)


@pytest.mark.parametrize("seed,rows_per_task", [(5, 3), (6, 1), (7, 10_000)])
def test_lecture_history_matches_loop(spark, seed, rows_per_task):
    rows, qs, ls, log, qdf, ldf = _frames(spark, seed)
    got = {r["row_id"]: r.asDict() for r in lec.lecture_history(log, qdf, ldf, rows_per_task=rows_per_task).collect()}
    want = lecture_loop(rows, qs, ls)
    assert set(got) == set(want)
    for rid, exp in want.items():
        for k, v in exp.items():
            assert got[rid][k] == v, (rid, k, got[rid][k], v)


@pytest.mark.parametrize("seed,rows_per_task", [(15, 3), (16, 1), (17, 10_000)])
def test_latest_matching_lectures_match_loop(spark, seed, rows_per_task):
    rows, qs, ls, log, qdf, ldf = _frames(spark, seed)
    cols = [f"{m}_{c}" for m in lec.MATCHES for c in ("id", "ts")]
    out = lec.last_matching_lectures(log, qdf, ldf, rows_per_task=rows_per_task)
    got = {r["row_id"]: tuple(r[c] for c in cols) for r in out.collect()}
    want = latest_lectures(rows, qs, ls)
    assert got == want and set(log.columns) <= set(out.columns)
    assert len({w[0::2] for w in want.values()}) > 3


def test_recent_mean_and_lags(spark):
    rows, _, _, log, _, _ = _frames(spark, 8)
    n = 3
    got = {r["row_id"]: r for r in h.recent_mean(log.filter("content_type_id = 0"), n, rows_per_task=4).collect()}
    diffs = {r["row_id"]: r["time_diff"] for r in h.time_diff(log, rows_per_task=4).collect()}
    nxt = {r["row_id"]: r["answer_time"] for r in h.answer_time(log, rows_per_task=4).collect()}
    by_user = {}
    for r in sorted(rows, key=lambda r: (r["timestamp"], r["row_id"])):
        by_user.setdefault(r["user_id"], []).append(r)
    for u, rs in by_user.items():
        qs = [r for r in rs if r["content_type_id"] == 0]
        for i, r in enumerate(qs):
            last = [x["answered_correctly"] for x in qs[max(0, i - n):i]]
            exp = sum(last) / len(last) if last else None
            assert _same(got[r["row_id"]][f"recent_mean_{n}"], exp)
        for i, r in enumerate(rs):
            assert diffs[r["row_id"]] == (r["timestamp"] - rs[i - 1]["timestamp"] if i else 0)
            assert _same(nxt[r["row_id"]], rs[i + 1]["prior_question_elapsed_time"] if i + 1 < len(rs) else None)


def test_task_size_does_not_change_results(spark):
    _, _, _, log, qdf, _ = _frames(spark, 9)
    q = join_dim(log.filter("content_type_id = 0"), qdf.select("question_id", "part"), "content_id", "question_id")
    cols = ["row_id", "answered_correctly_sum_u", "count_u", "part_sum_u", "part_count_u", "first_time"]
    a = sorted(h.add_user_feats(q, rows_per_task=1).select(*cols).collect())
    b = sorted(h.add_user_feats(q, rows_per_task=10**9).select(*cols).collect())
    assert a == b


def test_prior_features_ignore_future_rows(spark):
    _, _, _, log, qdf, _ = _frames(spark, 10)
    q = join_dim(log.filter("content_type_id = 0"), qdf.select("question_id", "part"), "content_id", "question_id")
    cut = 40
    cols = ["row_id", "answered_correctly_sum_u", "count_u", "part_sum_u", "first_time"]
    full = h.add_user_feats(q, rows_per_task=7).filter(F.col("timestamp") <= cut).select(*cols)
    past = h.add_user_feats(q.filter(F.col("timestamp") <= cut), rows_per_task=7).select(*cols)
    assert sorted(full.collect()) == sorted(past.collect())


def test_container_grain_rows_in_one_container_do_not_see_each_other(spark):
    rows = [dict(row_id=i, timestamp=0, user_id=1, content_id=5, content_type_id=0, task_container_id=c,
                 user_answer=0, answered_correctly=1, prior_question_elapsed_time=None,
                 prior_question_had_explanation=None)
            for i, c in enumerate([0, 0, 1, 1, 1, 3])]
    df = spark.createDataFrame(rows, INTERACTIONS)
    got = {r["row_id"]: r for r in h.add_user_feats(df, grain="container", with_part=False, rows_per_task=2).collect()}
    assert [got[i]["count_u"] for i in range(6)] == [0, 0, 2, 2, 2, 5]
    assert [got[i]["first_time"] for i in range(6)] == [1, 1, 0, 0, 0, 0]


def _hot_log(spark, burst: bool):
    import random
    rnd = random.Random(11)
    rows, rid = [], 0
    for u in range(20):
        n = 600 if u == 0 else 60  # user 0 holds a third of the log
        ts = 0 if not (burst and u == 0) else 5000  # burst: packed into a short span
        for _ in range(n):
            ts += rnd.choice([0, 1, 2, 5]) if not (burst and u == 0) else rnd.choice([0, 1])
            rows.append(dict(row_id=rid, timestamp=ts, user_id=u, content_id=rnd.randrange(9), content_type_id=0,
                             task_container_id=ts // 3, user_answer=0, answered_correctly=rnd.randint(0, 1),
                             prior_question_elapsed_time=None, prior_question_had_explanation=None,
                             part=rnd.randint(1, 7)))
            rid += 1
    df = spark.createDataFrame([{k: v for k, v in r.items() if k != "part"} for r in rows], INTERACTIONS)
    df = df.join(spark.createDataFrame([(r["row_id"], r["part"]) for r in rows], "row_id long, part int"), "row_id")
    return rows, df


@pytest.mark.parametrize("grain", ["row", "container"])
@pytest.mark.parametrize("burst", [False, True])
def test_hot_user_stays_exact(spark, burst, grain):
    rows, df = _hot_log(spark, burst)
    got = {r["row_id"]: r.asDict() for r in h.add_user_feats(df, grain=grain, rows_per_task=40).collect()}
    if grain == "row":
        want = user_feats(rows)
        for rid, exp in want.items():
            for k, v in exp.items():
                assert _same(got[rid][k], v), (rid, k)
        return
    by_user = {}
    for r in rows:
        by_user.setdefault(r["user_id"], []).append(r)
    for r in rows:
        earlier = [x for x in by_user[r["user_id"]] if x["task_container_id"] < r["task_container_id"]]
        g = got[r["row_id"]]
        assert (g["count_u"], g["answered_correctly_sum_u"]) == (len(earlier), sum(x["answered_correctly"] for x in earlier))
        assert g["part_count_u"] == sum(x["part"] == r["part"] for x in earlier)
        assert g["first_time"] == (not any(x["content_id"] == r["content_id"] for x in earlier))


def test_burst_is_cut_by_counts(spark):
    """A key with a few sparse rows and a packed burst: no range is far above the target."""
    from learnlog.operators.prefix import CHUNK, hot_keys, in_ranges
    target = 1000
    df = spark.range(200_000).select(F.lit(1).alias("user_id"), F.col("id").alias("row_id"),
                                     F.when(F.col("id") < 5, F.col("id") * 10**9).otherwise(10**10 + F.col("id") / 10).cast("long").alias("timestamp"))
    hot, total = hot_keys(df, ["user_id"], target)
    assert (hot.count(), total) == (1, 200_000)
    sizes = [r["count"] for r in in_ranges(df, ["user_id", "timestamp", "row_id"], total, target).groupBy(CHUNK).count().collect()]
    assert sum(sizes) == 200_000 and max(sizes) <= 2 * target
    instant = df.withColumn("timestamp", F.lit(7))     # one instant: cut by row_id
    sizes = [r["count"] for r in in_ranges(instant, ["user_id", "timestamp", "row_id"], total, target).groupBy(CHUNK).count().collect()]
    assert max(sizes) <= 2 * target


def test_recent_mean_of_a_hot_user(spark):
    _, df = _hot_log(spark, True)
    cols = ["row_id", "recent_mean_4"]
    a = sorted(h.recent_mean(df, 4, rows_per_task=40).select(*cols).collect())
    b = sorted(h.recent_mean(df, 4).select(*cols).collect())
    assert [(x[0], x[1] is None or round(x[1], 9)) for x in a] == [(x[0], x[1] is None or round(x[1], 9)) for x in b]


def test_frozen_state_of_a_hot_user(spark):
    from learnlog.operators import state as stt
    _, df = _hot_log(spark, False)
    state, rows = stt.build_state(df.where("row_id % 3 = 0")), df.where("row_id % 3 > 0")
    cols = ["row_id", "answered_correctly_sum_u", "count_u", "part_sum_u", "part_count_u", "first_time"]
    assert sorted(stt.apply_frozen_state(rows, state, rows_per_task=40).select(*cols).collect()) == \
        sorted(stt.apply_frozen_state(rows, state).select(*cols).collect())


def test_first_last_skip_by_position(spark, monkeypatch):
    from learnlog.operators import prefix, splits as sp
    rows, df = _hot_log(spark, True)
    order = [r["row_id"] for r in sorted(rows, key=lambda r: (r["timestamp"], r["row_id"]))]
    for limit in (4_000_000, 100):
        monkeypatch.setattr(prefix, "ROWS_PER_TASK", limit)
        ids = {f: {r["row_id"] for r in getattr(sp, f)(df, 700).collect()} for f in ("first_n", "last_n", "skip_n")}
        assert ids == {"first_n": set(order[:700]), "last_n": set(order[-700:]), "skip_n": set(order[700:])}


def test_container_load_over_ranges_of_equal_size(spark):
    """Dense ids and an outlier: sums don't depend on the ranges, and no range is large."""
    from fractions import Fraction

    from learnlog.operators import stats as st
    from learnlog.operators.prefix import in_ranges

    rng = __import__("random").Random(2)
    rows = [(c, u) for c in [*range(500, 1500), 10**9] for u in rng.choices(range(9), k=rng.randrange(1, 8))]
    q = spark.createDataFrame(rows, "task_container_id int, user_id long").repartition(6)
    plain = {r[0]: tuple(r[1:]) for r in st.container_load(q).collect()}
    assert {r[0]: tuple(r[1:]) for r in st.container_load(q, rows_per_task=50).collect()} == plain
    total = Fraction(0)
    for c in sorted({c for c, _ in rows}):
        users = [u for k, u in rows if k == c]
        total += Fraction(len(users), len(set(users)))
        assert plain[c][0] == len(users) / len(set(users)) and math.isclose(plain[c][1], float(total), rel_tol=1e-14)
    sizes = in_ranges(st.container_questions(q), ["task_container_id"], 1001, 50).groupBy("_chunk").count().collect()
    assert max(r["count"] for r in sizes) <= 100
