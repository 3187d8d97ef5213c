"""DuckDB SQL forms of the fixture views, used as CTE prefixes by the oracle.

These are the same definitions as ``sources/fixtures.py`` written in SQL so
every oracle query starts from identical inputs.
"""

INTERACTIONS = """
interactions AS (
  SELECT event_id AS row_id,
         "timestamp",
         user_id,
         CAST(CASE WHEN event_id % 2 = 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER)
              ELSE event_id // 5 END AS INTEGER) AS content_id,
         CAST(event_type = 'view' AS INTEGER) AS content_type_id,
         CAST(floor(("timestamp" - min("timestamp") OVER (PARTITION BY user_id)) / 86400000) AS INTEGER)
           AS task_container_id,
         CASE WHEN event_type = 'view' THEN -1 ELSE CAST(event_id % 4 AS INTEGER) END AS user_answer,
         CASE WHEN event_type = 'view' THEN -1
              WHEN event_type IN ('purchase', 'click') THEN 1 ELSE 0 END AS answered_correctly,
         CAST(lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS DOUBLE)
           AS prior_question_elapsed_time,
         lag(event_type = 'error') OVER (PARTITION BY user_id ORDER BY event_id)
           AS prior_question_had_explanation
  FROM (SELECT *, (epoch_us(ts) // 1000 - 1704067200000) AS "timestamp" FROM events) e
)"""

# The question tags expression over ``part`` (also used where a CTE cannot be
# referenced, e.g. inside a dynamic PIVOT).
QUESTION_TAGS = """CASE WHEN p_partkey % 19 = 0 THEN NULL
              ELSE concat_ws(' ', CAST(p_size AS VARCHAR),
                             CAST(CAST(p_partkey % 23 AS INTEGER) + 60 AS VARCHAR),
                             CAST(p_size + 10 AS VARCHAR)) END"""

QUESTIONS = f"""
questions AS (
  SELECT CAST(p_partkey AS INTEGER) AS question_id,
         CAST(floor(p_partkey / 3) AS INTEGER) AS bundle_id,
         CAST(p_partkey % 4 AS INTEGER) AS correct_answer,
         CAST(p_size % 7 + 1 AS INTEGER) AS part,
         {QUESTION_TAGS} AS tags
  FROM part WHERE p_partkey % 20 <> 19
)"""

LECTURES = """
lectures AS (
  SELECT CAST(p_partkey AS INTEGER) AS lecture_id,
         CAST(p_size AS INTEGER) AS tag,
         CAST(p_partkey % 7 AS INTEGER) + 1 AS part,
         CASE WHEN p_type LIKE '%PROMO%' THEN 'solving question'
              WHEN p_type LIKE '%SMALL%' THEN 'intention'
              WHEN p_type LIKE '%LARGE%' THEN 'starter'
              ELSE 'concept' END AS type_of
  FROM part WHERE p_partkey % 25 <> 24
)"""

ORDER_LOG = """
order_log AS (
  SELECT epoch_us(o_orderdate) // 1000 AS "timestamp",
         o_custkey AS user_id,
         CAST(l_partkey AS INTEGER) AS content_id,
         0 AS content_type_id,
         o_orderkey AS task_container_id,
         CAST(l_returnflag <> 'R' AS INTEGER) AS answered_correctly
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

ALL = {"interactions": INTERACTIONS, "questions": QUESTIONS,
       "lectures": LECTURES, "order_log": ORDER_LOG}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the named views as CTEs (in dependency order)."""
    ctes = ",\n".join(ALL[n] for n in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def test_batches_sql(batch_rows: int = 1000) -> str:
    """CTEs ``g`` (log with group_num) and ``batches`` (the test format)."""
    return f"""
g AS (SELECT *, row_id // {batch_rows} AS group_num FROM interactions),
lists AS (
  SELECT group_num,
         '[' || string_agg(CAST(answered_correctly AS VARCHAR), ', ' ORDER BY row_id) || ']' AS ans,
         '[' || string_agg(CAST(user_answer AS VARCHAR), ', ' ORDER BY row_id) || ']' AS resp
  FROM g GROUP BY group_num),
prev AS (
  SELECT group_num, coalesce(lag(ans) OVER (ORDER BY group_num), '[]') AS prior_group_answers_correct,
         coalesce(lag(resp) OVER (ORDER BY group_num), '[]') AS prior_group_responses
  FROM lists),
batches AS (
  SELECT g.* EXCLUDE (user_answer, answered_correctly), p.prior_group_answers_correct, p.prior_group_responses
  FROM g JOIN prev p ON g.group_num = p.group_num)"""


def std_int_sql(c: str) -> str:
    """SQL form of ``stats.std_int``: the same integer moments and the same
    chain of double operations."""
    n = f"CAST(count({c}) AS DOUBLE)"
    s = f"CAST(sum({c}) AS DOUBLE)"
    ss = f"CAST(sum(CAST({c} AS BIGINT) * CAST({c} AS BIGINT)) AS DOUBLE)"
    return (f"CASE WHEN count({c}) > 1 THEN sqrt(greatest({ss} - {s} * {s} / {n}, CAST(0 AS DOUBLE))"
            f" / ({n} - CAST(1 AS DOUBLE))) END")
