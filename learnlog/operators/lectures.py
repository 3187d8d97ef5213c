"""Lecture / question history counters (the reference's per-row loop that
re-scans all lectures a user has seen, as running aggregates over the union
of question and lecture rows).

Every feature is a running aggregate on ``(user, ...)`` keys, so cost is
linear in the log, not questions x lectures per user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import ORDER, PARTS
from .joins import join_dim
from .prefix import Agg, Family, running, running_families, spread

# Distinct sentinels so a NULL question part never matches a NULL lecture part.
Q_NULL_PART, L_NULL_PART = -1, -2
# Tag keys that never meet a real tag: a question without tags, a lecture
# missing from the lecture table.
NO_TAG, NO_LECTURE_TAG = -2147483647, -2147483648


def parse_tags(tags: str | Column = "tags") -> Column:
    """'1 23 45' -> array<int> (NULL stays NULL; bad tokens become NULL)."""
    c = F.col(tags) if isinstance(tags, str) else tags
    return F.transform(F.split(F.trim(c), " +"), lambda t: t.try_cast("int"))


def with_dims(log: DataFrame, questions: DataFrame, lectures: DataFrame) -> DataFrame:
    """Attach question part/tags to question rows and lecture tag/part to
    lecture rows (two broadcast-checked left joins)."""
    q = questions.select(F.col("question_id").alias("_qid"), F.col("part").alias("_q_part"),
                         F.col("tags").alias("_q_tags"))
    l = lectures.select(F.col("lecture_id").alias("_lid"), F.col("tag").alias("_l_tag"),
                        F.col("part").alias("_l_part"))
    is_q = F.col("content_type_id") == 0
    out = log.withColumn("_q_key", F.when(is_q, F.col("content_id")))
    out = out.withColumn("_l_key", F.when(~is_q, F.col("content_id")))
    out = join_dim(out, q, "_q_key", "_qid")
    out = join_dim(out, l, "_l_key", "_lid")
    return out.drop("_q_key", "_l_key")


def _counter_aggs() -> list[Agg]:
    is_l = (F.col("content_type_id") == 1).cast("int")
    is_q = (F.col("content_type_id") == 0).cast("int")
    aggs = [Agg("num_lecture_seen", "sum", is_l), Agg("num_question_seen", "sum", is_q)]
    aggs += [Agg(f"part{p}_seen", "sum", (is_q.cast("boolean") & (F.col("_q_part") == p)).cast("int"))
             for p in PARTS]
    # NULL part of a question counts in no part column.
    return [Agg(a.name, a.kind, F.coalesce(a.col, F.lit(0))) for a in aggs]


def _part_key() -> Column:
    is_q = F.col("content_type_id") == 0
    return (F.when(is_q, F.coalesce(F.col("_q_part"), F.lit(Q_NULL_PART)))
             .otherwise(F.coalesce(F.col("_l_part"), F.lit(L_NULL_PART))))


def lecture_counters(rows: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """num_lecture_seen, num_question_seen and part1_seen..part7_seen,
    counted up to and including each row, in one running pass on user."""
    return running(rows, ["user_id"], _counter_aggs(), order=ORDER, inclusive=True, rows_per_task=rows_per_task)


def num_tags_match(rows: DataFrame, rows_per_task: int | None = None, log: DataFrame | None = None) -> DataFrame:
    """Per question row: earlier lectures of the user (with multiplicity)
    whose tag is one of the question's tags.

    Each question row is copied once per distinct tag (at most a handful)
    after the shuffle on the user, lecture rows once; a running count of
    lectures per (user, tag), added up per row, is the match count. With the
    ``log`` that ``rows`` were made of, hot users are looked for there.
    """
    return _tag_copies(rows, [], rows_per_task, log).where("_copy = 0").drop(*_COPY_COLS)


# Copies of a row, about: a question has a handful of tags.
COPIES = 4
_COPY_COLS = ("_copy", "_tag0", "_tag", "_tag_lec")


def _copied(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Question rows once per distinct tag, lecture rows once, partitioned by
    user; tasks go by the rows of the ``log`` that ``rows`` were made of."""
    is_q = F.col("content_type_id") == 0
    tags = F.array_distinct(F.filter(parse_tags("_q_tags"), lambda t: t.isNotNull()))
    one = F.array(F.when(~is_q, F.col("_l_tag")).cast("int"))
    copies = spread(rows, ["user_id"], log.count()).select("*", F.posexplode(
        F.when(is_q & (F.coalesce(F.size(tags), F.lit(0)) > 0), tags).otherwise(one)).alias("_copy", "_tag0"))
    return copies.withColumn("_tag", F.coalesce(
        F.col("_tag0"), F.when(is_q, F.lit(NO_TAG)).otherwise(F.lit(NO_LECTURE_TAG))))


def _tag_copies(rows: DataFrame, families: list[Family], rows_per_task: int | None, log: DataFrame | None = None) -> DataFrame:
    """Rows copied once per tag, with the running aggregates of ``families``
    and ``num_tags_match`` (on every copy). One shuffle, on the user."""
    is_q = F.col("content_type_id") == 0
    # A question row is never a lecture, so "lectures up to and including" are the earlier ones.
    out = running_families(_copied(rows, rows if log is None else log), ["user_id"], [
        *families, Family((Agg("_tag_lec", "sum", (~is_q).cast("int")),), ("_tag",))],
        order=(*ORDER, "_copy"), inclusive=True, rows_per_task=rows_per_task, arranged=True, count_on=log and (log, COPIES))
    per_row = Window.partitionBy("user_id", "row_id")
    matched = F.when(is_q & F.col("_tag0").isNotNull(), F.col("_tag_lec")).otherwise(F.lit(0))
    return out.withColumn("num_tags_match", F.sum(matched).over(per_row).cast("long"))


def part_matches(rows: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """1 when an earlier lecture of the user has this question's part."""
    is_q = F.col("content_type_id") == 0
    out = running(rows.withColumn("_pk", _part_key()), ["user_id", "_pk"], [Agg("_lec_seen", "max", (~is_q).cast("int"))],
                  order=ORDER, rows_per_task=rows_per_task)
    return (out.withColumn("part_matches",
                           F.when(is_q, F.coalesce(F.col("_lec_seen"), F.lit(0))).otherwise(F.lit(0)))
               .drop("_pk", "_lec_seen"))


def _lecture_mark() -> Column:
    """A lecture row's place in time and its lecture; NULL for questions. The largest is the latest."""
    return F.when(F.col("content_type_id") == 1, F.struct(
        F.col("timestamp").alias("ts"), F.col("row_id").alias("rid"), F.col("content_id").alias("lid")))


def last_lecture_before(rows: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """As-of match: for each row, the user's latest earlier lecture
    (prev_lecture_id, prev_lecture_ts), NULL when none."""
    out = running(rows, ["user_id"], [Agg("_last_l", "max", _lecture_mark())], order=ORDER, rows_per_task=rows_per_task)
    return (out.withColumn("prev_lecture_id", F.col("_last_l.lid"))
               .withColumn("prev_lecture_ts", F.col("_last_l.ts"))
               .drop("_last_l"))


MATCHES = ("prev_lecture", "prev_tag_lecture", "prev_part_lecture")


def last_matching_lectures(log: DataFrame, questions: DataFrame, lectures: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """As-of match with conditions: for each row the user's latest earlier
    lecture, and for a question the latest one that has one of its tags, and the
    latest one of its part (``MATCHES``, each with ``_id`` and ``_ts``, NULL
    when none).

    A running maximum of (time, row, lecture) over the user, the (user, tag) of
    each of the question's tags and the (user, part); the largest over a
    question's tags is its match. Linear in rows and tags, one shuffle on the user.
    """
    is_q, mark = F.col("content_type_id") == 0, _lecture_mark()
    copies = _copied(with_dims(log, questions, lectures).withColumn("_pk", _part_key()), log)
    out = running_families(copies, ["user_id"], [
        Family((Agg("_prev_lecture", "max", mark),)),
        Family((Agg("_tag_match", "max", mark),), ("_tag",)),
        Family((Agg("_prev_part_lecture", "max", mark),), ("_pk",)),
    ], order=(*ORDER, "_copy"), rows_per_task=rows_per_task, arranged=True, count_on=(log, COPIES))
    per_row = Window.partitionBy("user_id", "row_id")
    out = out.withColumn("_prev_tag_lecture", F.max(F.when(is_q, F.col("_tag_match"))).over(per_row)).where("_copy = 0")
    out = out.withColumn("_prev_part_lecture", F.when(is_q, F.col("_prev_part_lecture")))
    named = {f"{m}_{c}": F.col(f"_{m}.{f}") for m in MATCHES for c, f in (("id", "lid"), ("ts", "ts"))}
    return out.withColumns(named).drop(*_COPY_COLS, "_pk", "_tag_match", *(f"_{m}" for m in MATCHES))


def lecture_history(log: DataFrame, questions: DataFrame, lectures: DataFrame,
                    rows_per_task: int | None = None) -> DataFrame:
    """All lecture-history features, returned for question rows only, with
    one shuffle of the rows: counters (on a question's first copy only), part
    match and tag match are families of one call over the user."""
    rows = with_dims(log, questions, lectures).withColumn("_pk", _part_key())
    is_q = F.col("content_type_id") == 0
    primary = (F.col("_copy") == 0).cast("int")
    out = _tag_copies(rows, [
        Family(tuple(Agg(a.name, a.kind, a.col * primary) for a in _counter_aggs())),
        Family((Agg("_lec_seen", "max", (~is_q).cast("int")),), ("_pk",)),
    ], rows_per_task, log)
    return (out.filter(is_q & (F.col("_copy") == 0))
               .withColumn("part_matches", F.coalesce(F.col("_lec_seen"), F.lit(0)))
               .drop("_pk", "_lec_seen", *_COPY_COLS))
