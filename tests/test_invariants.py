"""Split, state and partitioning invariants (survey 5, item 3 and 5)."""

from pyspark.sql import functions as F

from learnlog.operators import history as h
from learnlog.operators import splits as sp
from learnlog.operators import state as stt
from learnlog.plans.common import question_rows
from learnlog.sources import fixtures as fx

from conftest import SMOKE_SF


def test_tail_split_disjoint_complete(spark):
    q = fx.interactions(spark, SMOKE_SF).filter("content_type_id = 0")
    s = sp.user_tail_split(q)
    n = q.count()
    counts = {r["split"]: r["n"] for r in s.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(counts.values()) == n
    assert s.select("row_id").distinct().count() == n
    per_user = s.filter("split = 'valid'").groupBy("user_id").count().agg(F.max("count")).first()[0]
    assert per_user <= 5
    # valid rows are each user's latest
    last_train = s.filter("split <> 'valid'").groupBy("user_id").agg(F.max(F.struct("timestamp", "row_id")).alias("t"))
    first_valid = s.filter("split = 'valid'").groupBy("user_id").agg(F.min(F.struct("timestamp", "row_id")).alias("v"))
    assert last_train.join(first_valid, "user_id").filter(F.col("t") >= F.col("v")).count() == 0


def test_ordered_split_cut(spark):
    lg = fx.interactions(spark, SMOKE_SF)
    s = sp.ordered_split(lg)
    n = lg.count()
    assert s.filter("split = 'valid'").count() == -(-n * 2 // 10)
    t = s.filter("split = 'train'").agg(F.max(F.struct("timestamp", "row_id"))).first()[0]
    v = s.filter("split = 'valid'").agg(F.min(F.struct("timestamp", "row_id"))).first()[0]
    assert tuple(t) < tuple(v)


def test_random_split_is_stable_and_near_fractions(spark):
    lg = fx.interactions(spark, "/root/testdata/sf0.01")
    a = sp.random_split(lg).select("row_id", "split")
    b = sp.random_split(lg.repartition(3)).select("row_id", "split")
    assert a.exceptAll(b).count() == 0
    frac = a.filter("split = 'train'").count() / lg.count()
    assert 0.77 < frac < 0.83


def test_state_continuation_equals_one_pass(spark):
    q = question_rows(spark, SMOKE_SF)
    s = sp.ordered_split(q)
    train, valid = s.filter("split = 'train'").drop("split"), s.filter("split = 'valid'").drop("split")
    cols = ["row_id", "answered_correctly_sum_u", "count_u", "part_sum_u", "part_count_u", "first_time"]
    cont = stt.add_user_feats_continued(train, valid).select(*cols)
    one = h.add_user_feats(q).join(valid.select("row_id"), "row_id").select(*cols)
    assert sorted(cont.collect()) == sorted(one.collect())


def test_frozen_state_equals_state_at_cut(spark):
    q = question_rows(spark, SMOKE_SF)
    s = sp.ordered_split(q)
    train, valid = s.filter("split = 'train'").drop("split"), s.filter("split = 'valid'").drop("split")
    frozen = stt.apply_frozen_state(valid, stt.build_state(train))
    # for a user's first valid row, frozen and continued features agree
    first = sp.user_position(valid, "p").filter("p = 0").select("row_id")
    cols = ["row_id", "answered_correctly_sum_u", "count_u", "part_sum_u", "first_time"]
    cont = stt.add_user_feats_continued(train, valid)
    a = frozen.join(first, "row_id").select(*cols).collect()
    b = cont.join(first, "row_id").select(*cols).collect()
    assert sorted(a) == sorted(b)


def test_update_state_equals_state_of_union(spark):
    q = question_rows(spark, SMOKE_SF)
    s = sp.ordered_split(q)
    train, valid = s.filter("split = 'train'").drop("split"), s.filter("split = 'valid'").drop("split")
    upd = stt.update_state(stt.build_state(train), valid)
    full = stt.build_state(q)
    assert sorted(upd.user.collect()) == sorted(full.user.collect())
    assert sorted(upd.user_part.collect()) == sorted(full.user_part.collect())
    assert sorted(upd.user_content.collect()) == sorted(full.user_content.collect())


def test_results_do_not_depend_on_partition_count(spark):
    cols = ["row_id", "answered_correctly_sum_u", "count_u", "first_time", "part_count_u"]
    q = question_rows(spark, SMOKE_SF)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = sorted(h.add_user_feats(q.repartition(1)).select(*cols).collect())
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        b = sorted(h.add_user_feats(q.repartition(7)).select(*cols).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b
