"""Ensembles as node tables: the same scores as the fitted model, as SQL, and after a round trip."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from learnlog.functions.ensemble import NODES, Ensemble
from learnlog.models import committed
from learnlog.operators.model import GBTConfig, predict_scores, train_gbt


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(2)
    rows = []
    for i in range(1500):
        a, b, part, flag = rng.random(), rng.gauss(0, 3), rng.choice([1, 2, 3, 4, 5, 6, 7]), rng.random() < 0.4
        y = int(a + 0.3 * (part in (2, 5)) + 0.2 * flag + 0.1 * rng.random() > 0.8)
        rows.append((i, a, b, part, flag, y, i % 5 == 0))
    df = spark.createDataFrame(rows, "row_id long, a double, b double, part int, flag boolean, answered_correctly int, is_valid boolean")
    df = df.withColumn("flag", F.col("flag").cast("int"))
    features = ["a", "b", "part", "flag"]
    return train_gbt(df, features, cfg=GBTConfig(max_iter=12, max_depth=4, validation_tol=0.0), categorical=["part", "flag"]), df, features


def test_scores_equal_the_fitted_models(spark, fitted):
    model, df, features = fitted
    ensemble = Ensemble.of_model(model, features)
    assert {n.feature for n in ensemble.nodes} >= {"a", "part"} and len({n.tree for n in ensemble.nodes}) > 2
    # a part that training did not have, and one that is missing
    new = df.union(df.limit(40).withColumn("part", F.lit(9))).union(df.limit(40).withColumn("part", F.lit(None).cast("int")))
    new = new.withColumn("row_id", F.monotonically_increasing_id()).withColumn("a", F.when(F.rand(1) < 0.9, F.col("a")).otherwise(F.lit(float("nan")))).cache()
    want = {r["row_id"]: r["score"] for r in predict_scores(model, new).collect()}
    got = {r["row_id"]: r["score"] for r in new.select("row_id", ensemble.score().alias("score")).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    assert len(set(got.values())) > 10


def test_sql_and_round_trip(spark, fitted):
    model, df, features = fitted
    ensemble = Ensemble.from_json(Ensemble.of_model(model, features).to_json())
    assert ensemble == Ensemble.of_model(model, features)
    pdf = df.withColumn("part", F.when(F.col("row_id") % 7 > 0, F.col("part"))).withColumn("a", F.when(F.col("row_id") % 5 > 0, F.col("a"))).toArrow()
    back = spark.createDataFrame(pdf)
    con = duckdb.connect()
    con.register("rows", pdf)
    want = dict(con.execute(f"SELECT row_id, {ensemble.sql()} FROM rows").fetchall())
    got = {r[0]: r[1] for r in back.select("row_id", ensemble.score()).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-15 for k in got)


def test_node_table(spark, fitted):
    model, _, features = fitted
    ensemble = Ensemble.of_model(model, features)
    table = ensemble.table(spark)
    assert table.count() == len(ensemble.nodes) and table.schema == spark.createDataFrame([], NODES).schema
    # every node but the roots is the child of one other, and leaves have values
    nodes = [r.asDict() for r in table.collect()]
    children = sorted((n["tree"], c) for n in nodes if n["value"] is None for c in (n["left"], n["right"]))
    assert children == sorted((n["tree"], n["node"]) for n in nodes if n["node"])


@pytest.mark.parametrize("name", ["causal", "static", "lecture"])
def test_committed_models_are_whole(name):
    ensemble = committed(name)
    assert {n.feature for n in ensemble.nodes if n.feature} <= set(ensemble.features)
    for _, own in ensemble._trees():
        assert all(n.value is not None or (n.left in own and n.right in own) for n in own.values()) and 0 in own


@pytest.mark.parametrize("rows_per_task", [None, 100])
def test_permutation_importance_against_a_loop(spark, fitted, rows_per_task):
    import hashlib
    import math

    from learnlog.functions.metrics import permutation_importance

    model, df, features = fitted
    model = train_gbt(df, features, cfg=GBTConfig(max_iter=5, max_depth=3, validation_tol=0.0))
    ensemble = Ensemble.of_model(model, features)
    valid = df.where("is_valid").withColumn("b", F.when(F.col("row_id") % 3 > 0, F.col("b")))
    rows = [r.asDict() for r in valid.collect()]

    def auc(scored):
        pos, neg = [s for s, y in scored if y], [s for s, y in scored if not y]
        return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))

    def score(r):
        margin = 0.0
        for weight, own in ensemble._trees():
            n = own[0]
            while n.value is None:
                x = r[n.feature]
                n = own[n.left if x is not None and not math.isnan(x) and x <= n.threshold else n.right]
            margin += weight * n.value
        return 1 / (1 + math.exp(-2 * margin))

    whole = auc([(score(r), r["answered_correctly"]) for r in rows])
    got = {r["feature"]: r for r in permutation_importance(valid, ensemble, seed=3, rows_per_task=rows_per_task).collect()}
    assert set(got) == set(features)
    by_key = sorted(rows, key=lambda r: r["row_id"])
    for f in features:
        dealt = sorted(rows, key=lambda r: (hashlib.md5(f"3:{f}:{r['row_id']}".encode()).hexdigest(), r["row_id"]))
        permuted = auc([(score(r | {f: d[f]}), r["answered_correctly"]) for r, d in zip(by_key, dealt)])
        assert got[f]["auc"] == pytest.approx(whole, abs=1e-12) and got[f]["permuted_auc"] == pytest.approx(permuted, abs=1e-12)
    assert got["a"]["importance"] > 0.1


def test_permutation_importance_of_categories(spark, fitted):
    """The model with categories: each column dealt anew by hand, scored by the model itself."""
    from pyspark.sql import Window

    from learnlog.functions.metrics import permutation_importance, roc_auc

    model, df, features = fitted
    valid = df.where("is_valid")
    got = {r["feature"]: r["permuted_auc"] for r in permutation_importance(valid, Ensemble.of_model(model, features)).collect()}
    for f in ("part", "a"):
        by_key = valid.withColumn("p", F.row_number().over(Window.orderBy("row_id"))).drop(f)
        dealt = valid.select(f, F.row_number().over(Window.orderBy(F.md5(F.concat_ws(":", F.lit(7), F.lit(f), "row_id").cast("binary")))).alias("p"))
        scored = predict_scores(model, by_key.join(dealt, "p"), keep=("answered_correctly",))
        assert got[f] == pytest.approx(roc_auc(scored, "answered_correctly", "score").first()[0], abs=1e-12)
