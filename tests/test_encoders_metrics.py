"""Encoder numerics against NumPy, metrics against brute force and Spark ML."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from learnlog.functions import encoders as enc
from learnlog.functions import metrics as mt
from learnlog.functions.quantiles import quantiles
from learnlog.schema import QUESTIONS
from learnlog.sources import fixtures as fx

from conftest import CHECK_SF


def test_tags_pca_matches_numpy_svd(spark):
    q = fx.questions(spark, CHECK_SF)
    e = enc.TagsEncoder(5).fit(q)
    tf = e.tfidf(q).select("question_id", vector_to_array("_tfidf").alias("v")).orderBy("question_id").collect()
    X = np.array([r["v"] for r in tf])
    Xc = X - X.mean(axis=0)
    U, S, Vt = np.linalg.svd(Xc, full_matrices=False)
    scores = U[:, :5] * S[:5]
    for j in range(5):  # fixed sign: largest-magnitude loading positive
        if Vt[j, np.abs(Vt[j]).argmax()] < 0:
            scores[:, j] *= -1
    got = e.transform(q).orderBy("question_id").select(*[f"PCA_{i}" for i in range(5)]).collect()
    G = np.array([list(r) for r in got])
    assert np.allclose(G, scores, atol=1e-6)
    assert np.allclose(G.mean(axis=0), 0, atol=1e-9)  # centred (D6)


def test_tfidf_rows_are_unit_or_zero(spark):
    rows = [(1, 2, 0, 1, "11 22"), (2, 2, 0, 1, None), (3, 2, 0, 1, "7"), (4, 2, 0, 1, "11 11 33")]
    q = spark.createDataFrame(rows, QUESTIONS)
    e = enc.TagsEncoder(2).fit(q)
    norms = {r["question_id"]: float(np.linalg.norm(r["v"]))
             for r in e.tfidf(q).select("question_id", vector_to_array("_tfidf").alias("v")).collect()}
    assert norms[2] == 0 and norms[3] == 0  # NULL tags and one-character tags have no tokens (D5)
    assert abs(norms[1] - 1) < 1e-12 and abs(norms[4] - 1) < 1e-12


def test_exact_quantiles_match_numpy(spark):
    vals = [float(x) for x in np.random.default_rng(0).integers(0, 50, 997)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.11, 0.25, 0.5, 0.9, 1.0]
    assert np.allclose(quantiles(df, "x", probs), np.quantile(vals, probs))


def test_bins_with_fewer_distinct_values_than_bins(spark):
    df = spark.createDataFrame([(i % 3,) for i in range(30)], "timestamp long")
    edges = enc.quantile_edges(df, "timestamp", 50)
    vals = [i % 3 for i in range(30)]
    exp = sorted({round(float(x), 9) for x in np.quantile(vals, [k / 50 for k in range(51)])})
    assert np.allclose(edges, exp) and len(edges) < 51  # repeated edges merged (D17)
    got = [r[0] for r in df.select(enc.bin_index("timestamp", edges)).collect()]
    inner = np.array(edges[1:-1])
    assert got == [int(np.searchsorted(inner, v, side="right")) for v in vals]


def test_target_encoder_unseen_bin_gets_global_mean(spark):
    train = spark.createDataFrame([(t, t % 2) for t in range(100)], "timestamp long, answered_correctly int")
    e = enc.QuantileTargetEncoder(4).fit(train)
    out = e.transform(spark.createDataFrame([(None,)], "timestamp long")).first()
    assert out["tbins_qauc_encode"] == pytest.approx(0.5)


def test_auc_matches_brute_force_and_spark_ml(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) * 0.5 + y * 0.2, 1)  # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    got = mt.roc_auc(df, "y", "s").first()["auc"]
    pos, neg = s[y == 1], s[y == 0]
    brute = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert got == pytest.approx(brute, abs=1e-12)
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="yd", numBins=0)
    assert got == pytest.approx(ev.evaluate(df.withColumn("yd", F.col("y").cast("double"))), abs=1e-9)
    assert mt.scaled_auc(df, "y", "s").first()["auc2"] == pytest.approx(2 * brute)


def test_log_loss(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.0)], "y int, p double")
    got = mt.log_loss(df, "y", "p").first()["log_loss"]
    exp = -np.mean([np.log(0.9), np.log(0.8), np.log(1e-15)])
    assert got == pytest.approx(exp)


def test_label_encoders(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "t string")
    assert [r["t_enc"] for r in enc.label_encode(df, "t").orderBy("t").collect()] == [0, 0, 1, 2]
    dn = spark.createDataFrame([(5,), (-2,), (5,), (9,)], "v int")
    assert sorted((r["v"], r["v_enc"]) for r in enc.label_encode(dn, "v").collect()) == \
        [(-2, 0), (5, 1), (5, 1), (9, 2)]


def test_integer_std_is_exact_and_partition_independent(spark):
    from learnlog.operators.stats import std_int
    rng = np.random.default_rng(5)
    ys = rng.integers(0, 2, 5000)
    keys = rng.integers(0, 7, 5000)
    df = spark.createDataFrame([(int(k), int(y)) for k, y in zip(keys, ys)], "k int, y int")
    a = {r["k"]: r["s"] for r in df.repartition(1).groupBy("k").agg(std_int("y").alias("s")).collect()}
    b = {r["k"]: r["s"] for r in df.repartition(13).groupBy("k").agg(std_int("y").alias("s")).collect()}
    assert a == b  # bit for bit
    for k, v in a.items():
        assert v == pytest.approx(np.std(ys[keys == k], ddof=1), rel=1e-12)
    one = spark.createDataFrame([(1, 1)], "k int, y int").groupBy("k").agg(std_int("y").alias("s")).first()
    assert one["s"] is None


def test_auto_categorical_encodes_low_cardinality_and_fills_the_rest(spark):
    rows = [(i, "ab"[i % 2], i % 3, float(i) if i % 5 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "row_id long, s string, c int, x double")
    out, dims = enc.auto_categorical(df, ["s", "c", "x"], max_levels=200)
    assert dims == {"s": (0, 2), "c": (1, 3)}  # text, and fewer than 200 distinct values
    got = {r["row_id"]: r for r in out.collect()}
    assert {got[i]["s_enc"] for i in range(400)} == {0, 1} and {got[i]["c_enc"] for i in range(400)} == {0, 1, 2}
    mean_x = np.mean([float(i) for i in range(400) if i % 5])
    assert got[0]["x"] == pytest.approx(mean_x) and got[1]["x"] == 1.0  # own column's mean (D10)


def test_inferred_csv_reads_numbers_as_numbers(spark):
    import __spark_entry__ as entry
    df = entry.queries()["scan_inferred_csv"](spark, "/root/testdata/sf0.001")
    types = dict(df.dtypes)
    assert types["question_id"] in ("int", "bigint") and types["part"] in ("int", "bigint")
    assert types["tags"] == "string"


def test_auto_categorical_nulls_and_train_means(spark):
    rows = [(i, None if i % 7 == 0 else "ab"[i % 2], None if i % 4 == 0 else i % 3, float(i) if i % 5 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "row_id long, s string, c int, x double")
    out, dims = enc.auto_categorical(df, ["x", "s", "c"], train=F.col("row_id") < 100)
    assert dims == {"s": (1, 3), "c": (2, 4)}
    got = {r["row_id"]: r for r in out.collect()}
    assert got[4]["c_enc"] == 3 and got[1]["c_enc"] == 1 and got[0]["s"] == "missing"
    assert got[0]["x"] == pytest.approx(np.mean([i for i in range(100) if i % 5]))
    # exactly at the limit: 200 values are not fewer than 200
    df = spark.createDataFrame([(i, i % 200) for i in range(1000)], "row_id long, v int")
    assert enc.auto_categorical(df, ["v"])[1] == {} and enc.auto_categorical(df.where("v < 199"), ["v"])[1] == {"v": (0, 199)}


@pytest.mark.parametrize("rows_per_task", [None, 50])
def test_quantiles_with_outlier_nan_and_infinity(spark, rows_per_task):
    vals = [float(x) for x in range(10)]
    df = spark.createDataFrame([(v,) for v in [*vals, float("nan"), None]], "x double")
    assert quantiles(df, "x", [0.5], rows_per_task) == [4.5]
    many = [float(x) for x in range(1000)]
    out = spark.createDataFrame([(v,) for v in [*many, 1e12]], "x double")
    assert np.allclose(quantiles(out, "x", [0.0, 0.25, 0.5, 1.0], rows_per_task), np.quantile([*many, 1e12], [0.0, 0.25, 0.5, 1.0]))
    inf = spark.createDataFrame([(v,) for v in [*many, float("inf")]], "x double")
    assert quantiles(inf, "x", [0.5, 1.0], rows_per_task) == [500.0, float("inf")]
    assert quantiles(df.where("false"), "x", [0.5]) == [None]


@pytest.mark.parametrize("k,error", [(2048, None), (8, None), (8, 1e-9), (200, 0.0)])
def test_quantiles_whatever_the_sketch_says(spark, monkeypatch, k, error):
    """Small sketches, and brackets that miss the wanted ranks: several columns, ties, few distinct values."""
    from learnlog.functions import quantiles as qt

    if error is not None:
        monkeypatch.setattr(qt, "rank_error", lambda k: error)
    rng = np.random.default_rng(k)
    cols = {"a": rng.normal(size=3000), "b": rng.integers(0, 4, 3000).astype(float), "c": np.round(rng.exponential(size=3000), 1), "d": np.full(3000, -0.5)}
    df = spark.createDataFrame([tuple(float(v[i]) for v in cols.values()) for i in range(3000)], ", ".join(f"{c} double" for c in cols)).repartition(5)
    probs = [0.0, 0.001, 0.1, 0.25, 0.33, 0.5, 0.9, 0.999, 1.0]
    got = qt.column_quantiles(df, {c: F.col(c) for c in cols}, probs, k=k)
    for c, v in cols.items():
        assert np.allclose(got[c], np.quantile(v, probs), atol=0, rtol=1e-12), c
    assert qt.column_quantiles(df, {"a": F.col("a")}, []) == {"a": []}


def test_a_quantile_keeps_few_values_and_reads_twice(spark):
    """The second pass keeps what lies in the brackets, once."""
    from learnlog.functions import quantiles as qt

    df = spark.range(0, 400_000, 1, 6).select((F.xxhash64("id") / 2**40).alias("x"))
    kept, refined = [], qt._refined

    def counted(long, brackets, wanted, limit):
        lo, hi = brackets["x"][0]
        kept.append(long.where(F.col("_x").between(lo, hi)).count())
        return refined(long, brackets, wanted, limit)

    qt._refined = counted
    try:
        got, = qt.quantiles(df, "x", [0.5])
    finally:
        qt._refined = refined
    values = np.array([r[0] for r in df.collect()])
    assert got == pytest.approx(np.quantile(values, 0.5), rel=1e-12)
    assert len(kept) == 1 and kept[0] <= 400_000 * 2.5 * qt.rank_error(qt.SKETCH)


def test_auc_in_ranges_with_outlier_and_nan(spark):
    rng = np.random.default_rng(4)
    y, s = rng.integers(0, 2, 500), np.round(rng.random(500), 2)
    s[0] = 1e9
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)] + [(1, float("nan")), (None, 0.3), (0, None)], "y int, s double")
    pos, neg = s[y == 1], s[y == 0]
    brute = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    for limit in (None, 20):
        assert mt.roc_auc(df, "y", "s", limit).first()["auc"] == pytest.approx(brute, abs=1e-12)


def test_bins_keep_their_digits(spark):
    df = spark.createDataFrame([(i / 1e5,) for i in range(1000)], "x double")
    edges = enc.quantile_edges(df, "x", 50)
    assert len(edges) == 51
    got = [r[0] for r in df.select(enc.bin_index("x", edges)).collect()]
    assert got == [int(np.searchsorted(np.array(edges[1:-1]), i / 1e5, side="right")) for i in range(1000)]


def test_tags_pca_scores_are_centred_with_falling_variance(spark):
    q = fx.questions(spark, CHECK_SF)
    e = enc.TagsEncoder(5).fit(q)
    r = e.transform(q).agg(*[F.avg(f"PCA_{i}").alias(f"m{i}") for i in range(5)], *[F.var_pop(f"PCA_{i}").alias(f"v{i}") for i in range(5)]).first()
    assert all(abs(r[f"m{i}"]) < 1e-9 for i in range(5)) and all(r[f"v{i}"] >= r[f"v{i + 1}"] for i in range(4))
