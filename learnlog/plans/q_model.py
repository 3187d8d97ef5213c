"""Queries for the model and metrics (survey 2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics as mt
from ..models import committed
from ..operators import model as md
from ..operators import stats as st
from ..operators.joins import join_dim
from ..oracle_views import with_views
from ..registry import register
from ..session import stored
from ..sources import fixtures as fx
from .causal import CATEGORICAL, FEATURES, PCA_KEEP, PLAN_A, RATES, filled_plan_a, plan_a_features, question_dim_with_pca
from .common import log
from .q_joins import CSTATS
from .q_state import _sql as state_sql
from .q_state import train_valid

_MODELS: dict = {}

_FEATS = """
tfeats AS (
  SELECT t.row_id, false AS is_valid,
         CAST(coalesce(sum(answered_correctly) OVER u, 0) AS BIGINT) AS su, count(*) OVER u AS cu,
         CAST(coalesce(sum(answered_correctly) OVER p, 0) AS BIGINT) AS sp, count(*) OVER p AS cp,
         CASE WHEN row_number() OVER (PARTITION BY user_id, content_id ORDER BY "timestamp", row_id) = 1 THEN 1 ELSE 0 END AS first_time
  FROM train t
  WINDOW u AS (PARTITION BY user_id ORDER BY "timestamp", row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         p AS (PARTITION BY user_id, coalesce(part, -1) ORDER BY "timestamp", row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
vfeats AS (
  SELECT v.row_id, true AS is_valid, coalesce(us.s, 0) AS su, coalesce(us.c, 0) AS cu, coalesce(ps.s, 0) AS sp, coalesce(ps.c, 0) AS cp,
         CASE WHEN cs.user_id IS NULL THEN 1 ELSE 0 END AS first_time
  FROM valid v LEFT JOIN us ON v.user_id = us.user_id
  LEFT JOIN ps ON v.user_id = ps.user_id AND coalesce(v.part, -1) = ps.part_k
  LEFT JOIN cs ON v.user_id = cs.user_id AND v.content_id = cs.content_id),"""
PLAN_A_BODY = f""", {_FEATS.strip()}
{CSTATS.strip().replace("FROM interactions WHERE content_type_id = 0", "FROM train")},
plan_a AS (SELECT q.row_id, q.user_id, q.content_id, f.is_valid, q.answered_correctly,
       CAST(f.su AS DOUBLE) / nullif(f.cu, 0) AS answered_correctly_avg_u, f.su AS answered_correctly_sum_u, f.cu AS count_u,
       c.answered_correctly_avg_c, q.part, CAST(coalesce(q.prior_question_had_explanation, false) AS INTEGER) AS prior_question_had_explanation,
       coalesce(q.prior_question_elapsed_time, (SELECT avg(prior_question_elapsed_time) FROM train)) AS prior_question_elapsed_time,
       f.first_time, CAST(f.sp AS DOUBLE) / nullif(f.cp, 0) AS part_avg_u, f.sp AS part_sum_u, f.cp AS part_count_u,
       c.answered_correctly_sum_c, c.answered_correctly_count_c, c.answered_correctly_std_c
FROM (SELECT * FROM tfeats UNION ALL SELECT * FROM vfeats) f JOIN qrows q ON f.row_id = q.row_id
LEFT JOIN cstats c ON q.content_id = c.content_id)"""
PLAN_A_SQL = state_sql(f"{PLAN_A_BODY}\nSELECT * FROM plan_a")


@register("plan_a_features", PLAN_A_SQL)
def plan_a(spark, sf):
    return plan_a_features(*train_valid(spark, sf))


def model_table(spark, sf):
    """Plan A's features with the tags' PCA scores, NULLs imputed."""
    pca = question_dim_with_pca(fx.questions(spark, sf)).drop("part")
    f = plan_a_features(*[join_dim(d.drop("question_id"), pca, "content_id", "question_id") for d in train_valid(spark, sf)])
    return f.fillna(0.65, list(RATES)).fillna(0.0, [c for c in [*PLAN_A, *PCA_KEEP] if c not in RATES])


def fitted(spark, sf):
    """The model and its table, once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        table = stored(model_table(spark, sf), "model-table")      # the fit and the scores read it
        _MODELS[key] = (md.train_gbt(table, FEATURES, categorical=CATEGORICAL), table)
    return _MODELS[key]


@register("train_gbt")
def train_gbt(spark, sf):
    model, table = fitted(spark, sf)
    valid = table.filter("is_valid")
    return mt.roc_auc(md.predict_scores(model, valid).join(valid.select("row_id", "answered_correctly"), "row_id"),
                      "answered_correctly", "score")


_FILLED = ", ".join(f"coalesce(CAST({c} AS DOUBLE), {0.65 if c in RATES else 0.0}) AS {c}" for c in PLAN_A)


@register("predict_scores", state_sql(f"""{PLAN_A_BODY.strip()}
SELECT row_id, {committed("causal").sql()} AS score FROM (SELECT row_id, {_FILLED} FROM plan_a WHERE is_valid) f"""))
def predict_scores(spark, sf):
    # The committed model, as a column expression, over plan A's valid rows.
    rows = filled_plan_a(*train_valid(spark, sf)).filter("is_valid")
    return rows.select("row_id", committed("causal").score().alias("score"))


@register("predict_scores_trained")
def predict_scores_trained(spark, sf):
    model, table = fitted(spark, sf)
    return md.predict_scores(model, table.filter("is_valid"))


@register("feature_importance")
def feature_importance(spark, sf):
    model, _ = fitted(spark, sf)
    return md.feature_importance(model, FEATURES, spark)


def _permuted_sql(features, score: str, seed: int = 7) -> str:
    """AUC of ``filled(row_id, y, features)`` with each feature dealt to other rows ('': none)."""
    parts = [f"SELECT '' AS feature, y, {score} AS score FROM placed"]
    for f in features:
        dealt = f"SELECT {f} AS x, row_number() OVER (ORDER BY md5('{seed}:{f}:' || row_id), row_id) AS place FROM filled"
        parts.append(f"SELECT '{f}', y, {score} FROM (SELECT p.* REPLACE (d.x AS {f}) FROM placed p JOIN ({dealt}) d ON p.place = d.place) t")
    return f"""placed AS (SELECT *, row_number() OVER (ORDER BY row_id) AS place FROM filled),
permuted AS ({" UNION ALL ".join(parts)}),
counts AS (SELECT feature, score, sum(y) AS pos, sum(1 - y) AS neg FROM permuted GROUP BY ALL),
below AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY feature ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM counts),
aucs AS (SELECT feature, sum(pos * (nb + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS auc FROM below GROUP BY feature)
SELECT a.feature, w.auc, a.auc AS permuted_auc, w.auc - a.auc AS importance FROM aucs a, aucs w WHERE a.feature <> '' AND w.feature = ''"""


@register("permutation_importance", state_sql(f"""{PLAN_A_BODY.strip()},
filled AS (SELECT row_id, answered_correctly AS y, {_FILLED} FROM plan_a WHERE is_valid),
{_permuted_sql(PLAN_A, committed("causal").sql())}"""))
def permutation_importance(spark, sf):
    rows = filled_plan_a(*train_valid(spark, sf)).filter("is_valid")
    return mt.permutation_importance(rows, committed("causal"))


SCORED_SQL = """
scored AS (
  SELECT i.answered_correctly AS y, c.m AS score
  FROM interactions i JOIN (SELECT content_id, avg(answered_correctly) AS m FROM interactions
                            WHERE content_type_id = 0 GROUP BY content_id) c ON i.content_id = c.content_id
  WHERE i.content_type_id = 0
),
g AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY score),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                AS neg_below FROM g)"""
AUC_SQL = "sum(pos * (neg_below + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg))"


def scored(spark, sf):
    q = log(spark, sf).filter(F.col("content_type_id") == 0)
    m = st.named_stats(q, "content_id", {"score": F.avg("answered_correctly")})
    return q.join(m, "content_id", "left")


@register("roc_auc", with_views(f"WITH {SCORED_SQL.strip()}\nSELECT {AUC_SQL} AS auc FROM c", "interactions"))
def roc_auc(spark, sf):
    return mt.roc_auc(scored(spark, sf), "answered_correctly", "score")


@register("scaled_auc_metric", with_views(f"WITH {SCORED_SQL.strip()}\nSELECT 2 * {AUC_SQL} AS auc2 FROM c",
                                          "interactions"))
def scaled_auc_metric(spark, sf):
    return mt.scaled_auc(scored(spark, sf), "answered_correctly", "score")


@register("log_loss", with_views(f"""WITH {SCORED_SQL.strip()}
SELECT -avg(y * ln(least(greatest(score, 1e-15), 1 - 1e-15))
            + (1 - y) * ln(1 - least(greatest(score, 1e-15), 1 - 1e-15))) AS log_loss FROM scored""",
    "interactions"))
def log_loss(spark, sf):
    return mt.log_loss(scored(spark, sf), "answered_correctly", "score")
