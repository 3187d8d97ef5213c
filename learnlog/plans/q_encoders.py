"""Queries for the learned encoders (survey 2.9)."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from ..functions import encoders as enc
from ..oracle_views import with_views
from ..registry import register
from ..sources import fixtures as fx
from .common import log


def _edges_sql(n: int, name: str) -> str:
    probs = ", ".join(repr(k / n) for k in range(n + 1))
    return (f"{name} AS (SELECT list_sort(list_distinct("
            f"quantile_cont(\"timestamp\", [{probs}]))) AS e FROM interactions)")


def _bin_sql(edges: str, op: str) -> str:
    return (f"CAST(len(list_filter(list_slice({edges}.e, 2, len({edges}.e) - 1), "
            f"lambda b: b {op} i.\"timestamp\")) AS INTEGER)")


Q50 = f"""WITH {_edges_sql(50, 'e50')},
b50 AS (SELECT i.*, {_bin_sql('e50', '<=')} AS ts_bin FROM interactions i, e50)"""
Q200 = f"""WITH {_edges_sql(200, 'e200')},
b200 AS (SELECT i.*, {_bin_sql('e200', '<')} AS ts_bin FROM interactions i, e200)"""


@register("quantile_bins", with_views(f"{Q50}\nSELECT row_id, \"timestamp\", ts_bin FROM b50", "interactions"))
def quantile_bins(spark, sf):
    lg = log(spark, sf)
    edges = enc.quantile_edges(lg, "timestamp", 50)
    return lg.select("row_id", "timestamp", enc.bin_index("timestamp", edges).alias("ts_bin"))


TARGET_SQL = f"""{Q50},
means AS (SELECT ts_bin, avg(answered_correctly) AS tbins_qauc_encode FROM b50
          WHERE answered_correctly <> -1 GROUP BY ts_bin)"""


@register("bin_target_mean", with_views(f"{TARGET_SQL}\nSELECT * FROM means", "interactions"))
def bin_target_mean(spark, sf):
    return enc.QuantileTargetEncoder(50).fit(log(spark, sf)).table


@register("quantile_target_encode", with_views(f"""{TARGET_SQL}
SELECT b.row_id, b.ts_bin,
       coalesce(m.tbins_qauc_encode, (SELECT avg(answered_correctly) FROM interactions WHERE answered_correctly <> -1))
         AS tbins_qauc_encode
FROM b50 b LEFT JOIN means m ON b.ts_bin = m.ts_bin""", "interactions"))
def quantile_target_encode(spark, sf):
    lg = log(spark, sf)
    e = enc.QuantileTargetEncoder(50).fit(lg)
    return e.transform(lg).select("row_id", "ts_bin", "tbins_qauc_encode")


@register("qcut_bins", with_views(f"{Q200}\nSELECT row_id, ts_bin FROM b200", "interactions"))
def qcut_bins(spark, sf):
    lg = log(spark, sf)
    edges = enc.quantile_edges(lg, "timestamp", 200)
    return lg.select("row_id", enc.bin_index("timestamp", edges, right_closed=True).alias("ts_bin"))


COUNTS_SQL = f"""{Q200},
counts AS (SELECT ts_bin, CAST(sum(CASE WHEN answered_correctly = 0 THEN 1 ELSE 0 END) AS BIGINT) AS c0,
                  CAST(sum(CASE WHEN answered_correctly = 1 THEN 1 ELSE 0 END) AS BIGINT) AS c1
           FROM b200 WHERE answered_correctly <> -1 GROUP BY ts_bin)"""


@register("bin_label_counts", with_views(f"{COUNTS_SQL}\nSELECT * FROM counts", "interactions"))
def bin_label_counts(spark, sf):
    lg = log(spark, sf)
    edges = enc.quantile_edges(lg, "timestamp", 200)
    return enc.bin_label_counts(lg.withColumn("ts_bin", enc.bin_index("timestamp", edges, right_closed=True)))


CLUSTER_SQL = f"""{COUNTS_SQL},
rates AS (SELECT *, CAST(round_even(CAST(CAST(c1 AS DOUBLE) / (c0 + c1) AS DECIMAL(18, 6)), 2) AS DOUBLE) AS rate
          FROM counts),
capped AS (SELECT *, CASE WHEN rate > (SELECT median(rate) FROM rates) THEN 1.0 ELSE rate END AS v FROM rates),
clusters AS (SELECT ts_bin, c0, c1, rate, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS ts_cluster
             FROM capped)"""


@register("time_bin_cluster", with_views(f"{CLUSTER_SQL}\nSELECT * FROM clusters", "interactions"))
def time_bin_cluster(spark, sf):
    table, _ = enc.time_bin_cluster(log(spark, sf), 200)
    return table


@register("join_bin_encoding", with_views(f"""{CLUSTER_SQL}
SELECT b.row_id, b.ts_bin, c.ts_cluster FROM b200 b LEFT JOIN clusters c ON b.ts_bin = c.ts_bin""",
    "interactions"))
def join_bin_encoding(spark, sf):
    lg = log(spark, sf)
    table, edges = enc.time_bin_cluster(lg, 200)
    b = lg.withColumn("ts_bin", enc.bin_index("timestamp", edges, right_closed=True))
    # The cluster table has at most 200 rows (one per bin).
    return b.join(F.broadcast(table.select("ts_bin", "ts_cluster")), "ts_bin", "left").select(
        "row_id", "ts_bin", "ts_cluster")


@register("label_encode", with_views("""
SELECT lecture_id, type_of, CAST(dense_rank() OVER (ORDER BY type_of) - 1 AS INTEGER) AS type_of_enc FROM lectures""",
    "lectures"))
def label_encode(spark, sf):
    return enc.label_encode(fx.lectures(spark, sf), "type_of").select("lecture_id", "type_of", "type_of_enc")


@register("label_encode_numbers", with_views("""
SELECT row_id, task_container_id,
       CAST(dense_rank() OVER (ORDER BY task_container_id) - 1 AS INTEGER) AS task_container_id_enc
FROM interactions""", "interactions"))
def label_encode_numbers(spark, sf):
    return enc.label_encode(log(spark, sf), "task_container_id").select(
        "row_id", "task_container_id", "task_container_id_enc")


def _auto_sql(c: str) -> str:
    """A column and its code as ``auto_categorical`` gives them, if it has under 200 values."""
    return (f"{c}, CAST(CASE WHEN {c} IS NULL THEN (SELECT count(DISTINCT {c}) FROM interactions)"
            f" ELSE dense_rank() OVER (ORDER BY {c} NULLS LAST) - 1 END AS INTEGER) AS {c}_enc")


# The answer and the content type have few values at any scale, the elapsed time
# has many; its mean comes from four fifths of the rows.
@register("auto_categorical", with_views(f"""
SELECT row_id, {_auto_sql("user_answer")}, {_auto_sql("content_type_id")},
       coalesce(prior_question_elapsed_time, (SELECT avg(prior_question_elapsed_time) FROM interactions WHERE row_id % 5 <> 0))
         AS prior_question_elapsed_time
FROM interactions""", "interactions"))
def auto_categorical(spark, sf):
    out, _ = enc.auto_categorical(log(spark, sf), ["user_answer", "content_type_id", "prior_question_elapsed_time"],
                                  train=F.col("row_id") % 5 != 0)
    return out


TFIDF_SQL = """
docs AS (SELECT question_id, coalesce(tags, ' ') AS doc FROM questions),
toks AS (SELECT question_id, unnest(regexp_extract_all(lower(doc), '\\w\\w+')) AS token FROM docs),
tf AS (SELECT question_id, token, count(*) AS tf FROM toks GROUP BY ALL),
dfs AS (SELECT token, count(DISTINCT question_id) AS df FROM tf GROUP BY token),
n AS (SELECT count(*) AS n FROM docs),
w AS (SELECT tf.question_id, tf.token, tf.tf * (ln((1.0 + n.n) / (1.0 + dfs.df)) + 1.0) AS w
      FROM tf JOIN dfs ON tf.token = dfs.token, n)"""


@register("tags_tfidf", with_views(f"""WITH {TFIDF_SQL.strip()}
SELECT question_id, token, w / sqrt(sum(w * w) OVER (PARTITION BY question_id)) AS weight FROM w""", "questions"))
def tags_tfidf(spark, sf):
    q = fx.questions(spark, sf)
    return enc.TagsEncoder(5).fit(q).tfidf_long(q, "question_id")


@register("tags_pca")
def tags_pca(spark, sf):
    # R: checked against a NumPy SVD of the same TF-IDF matrix in tests.
    q = fx.questions(spark, sf)
    e = enc.TagsEncoder(5).fit(q)
    return e.transform(q).select("question_id", *[f"PCA_{i}" for i in range(5)])


# All components together keep the TF-IDF weights' total variance, and scores are centred (D6).
@register("tags_pca_moments", with_views(f"""
WITH {TFIDF_SQL.strip()},
long AS (SELECT question_id, token, w / sqrt(sum(w * w) OVER (PARTITION BY question_id)) AS x FROM w),
m AS (SELECT token, sum(x) / (SELECT n FROM n) AS mean, sum(x * x) / (SELECT n FROM n) AS square FROM long GROUP BY token)
SELECT (SELECT n FROM n) AS n, round(sum(square - mean * mean), 6) AS total_variance, 0.0::DOUBLE AS largest_mean FROM m""", "questions"))
def tags_pca_moments(spark, sf):
    q = fx.questions(spark, sf)
    e = enc.TagsEncoder(1 << 20).fit(q)
    names = [f"PCA_{i}" for i in range(len(e.vocab))]
    sums = e.transform(q).agg(F.count(F.lit(1)).alias("n"), *[F.var_pop(c).alias(f"v_{c}") for c in names], *[F.avg(c).alias(f"m_{c}") for c in names])
    total = functools.reduce(lambda a, b: a + b, [F.col(f"v_{c}") for c in names])
    return sums.select("n", F.round(total, 6).alias("total_variance"),
                       F.abs(F.round(F.greatest(*[F.abs(f"m_{c}") for c in names]), 6)).alias("largest_mean"))
