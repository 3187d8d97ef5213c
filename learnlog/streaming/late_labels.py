"""Scoring batches whose labels arrive one batch late (survey 2.11
stream_late_labels, stream_batch_filter).

Batch g carries the answers of the batch before it as a text list, positional
on that batch's rows (D18). ``foreachBatch`` handles a micro-batch (*epoch*)
with any number of batches:

1. the epoch's rows get their positions and are written to ``rows/epoch=e``;
2. answers are joined to the rows they belong to: rows of this epoch, or the
   last batch of the epoch before;
3. a question row's features are the state before the epoch plus a running
   aggregate over the answered rows of earlier batches in it (a RANGE frame on
   the batch number, so rows of one batch never see each other);
4. what this epoch's answers add to the state is written to ``delta/epoch=e``,
   only for the users they are of. Every ``COMPACT`` epochs the sum of all is
   written to ``base/epoch=e``.

Epoch e reads what the epochs before e wrote and overwrites what it wrote
itself, so an epoch that is replayed, after a crash at any point, gives the
same result and folds nothing twice. Something missing that an earlier epoch
must have written is an error.

Features of batch g therefore equal a container-grain history with the
batch as the container.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import add_user_feats, part_key, ratio
from ..operators.joins import join_dim
from ..operators.prefix import Agg, running
from ..operators.state import State, build_state, load_state, merge_states, save_state
from ..schema import TEST_BATCHES
from ..session import delete_path

FEATURE_COLS = ["row_id", "user_id", "content_id", "group_num", "answered_correctly_sum_u", "count_u",
                "answered_correctly_avg_u", "part_sum_u", "part_count_u", "part_avg_u", "first_time"]
# Epochs after which their deltas are summed up.
COMPACT = 16


def empty_state(spark: SparkSession) -> State:
    return State(spark.createDataFrame([], "user_id long, answered_correctly_sum_u long, count_u long"),
                 spark.createDataFrame([], "user_id long, part_k int, part_sum_u long, part_count_u long"),
                 spark.createDataFrame([], "user_id long, content_id int"))


class LateLabelScorer:
    """``foreachBatch`` handler; ``base`` is a folder on shared storage."""

    def __init__(self, spark: SparkSession, base: str, questions: DataFrame, init: State | None = None):
        self.spark, self.base = spark, base.rstrip("/")
        self.questions = questions.select("question_id", "part")
        self.init = init

    def _path(self, kind: str, epoch: int) -> str:
        return f"{self.base}/{kind}/epoch={epoch:09d}"

    def state_before(self, epoch: int) -> State:
        """State after all epochs before this one: the last sum of them, and the deltas since."""
        last = (epoch - 1) // COMPACT * COMPACT
        parts = [self.init or empty_state(self.spark)] if last <= 0 else [load_state(self.spark, self._path("base", last))]
        parts += [load_state(self.spark, self._path("delta", e)) for e in range(last + 1 if last > 0 else 0, epoch)]
        return merge_states(*parts)

    def _rows(self, batch: DataFrame, epoch: int) -> DataFrame:
        """The epoch's rows with positions, stored, and the last batch of the epoch before (not ``_scored``)."""
        rows = running(batch, ["group_num"], [Agg("_pos", "count", F.lit(1))], order=("row_id",)).withColumn("_scored", F.lit(True))
        if epoch > 0:
            before = self.spark.read.parquet(self._path("rows", epoch - 1))
            last = before.agg(F.max("group_num")).first()[0]
            rows = rows.unionByName(before.where(F.col("group_num") == F.lit(last)).withColumn("_scored", F.lit(False)))
        rows.write.mode("overwrite").parquet(self._path("rows", epoch))
        return self.spark.read.parquet(self._path("rows", epoch))

    def _labelled(self, rows: DataFrame) -> DataFrame:
        """Question rows with the answers that this epoch delivers (NULL: not yet)."""
        groups = rows.groupBy("group_num").agg(F.first(F.when(F.col("_scored"), F.col("prior_group_answers_correct")), ignorenulls=True).alias("_list"))
        answers = running(groups, [], [Agg("_of", "last", F.col("group_num"))], order=("group_num",)).select(
            F.col("_of").alias("group_num"), F.posexplode(F.from_json("_list", "array<int>")).alias("_pos", "_answer"))
        q = rows.filter(F.col("content_type_id") == 0).join(
            answers.withColumn("_pos", F.col("_pos").cast("long")), ["group_num", "_pos"], "left")
        q = q.withColumn("answered_correctly", F.when(F.col("_answer") != -1, F.col("_answer"))).drop("_answer")
        return join_dim(q, self.questions, "content_id", "question_id")

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        labelled = self._labelled(self._rows(batch, epoch))
        state = self.state_before(epoch)
        save_state(build_state(labelled.where("answered_correctly is not null")), self._path("delta", epoch))
        within = add_user_feats(labelled, grain="container", container="group_num", answered_only=True)
        features(within.where("_scored"), state).select(*FEATURE_COLS).write.mode("overwrite").parquet(self._path("out", epoch))
        if epoch and epoch % COMPACT == 0:
            save_state(self.state_before(epoch + 1) if epoch + 1 <= COMPACT else merge_states(state, load_state(self.spark, self._path("delta", epoch))),
                       self._path("base", epoch))
            for old in range(max(0, epoch - 2 * COMPACT), epoch - COMPACT):      # no replay reaches back so far
                for kind in ("delta", "rows", "base"):
                    delete_path(self.spark, self._path(kind, old))


def features(rows: DataFrame, state: State) -> DataFrame:
    """Running features of ``rows`` within an epoch, plus the state before it."""
    s = state.user.select("user_id", F.col("answered_correctly_sum_u").alias("_s"), F.col("count_u").alias("_n"))
    p = state.user_part.select("user_id", "part_k", F.col("part_sum_u").alias("_ps"), F.col("part_count_u").alias("_pn"))
    out = (rows.withColumn("part_k", part_key()).join(s, "user_id", "left").join(p, ["user_id", "part_k"], "left")
               .join(state.user_content.withColumn("_seen", F.lit(True)), ["user_id", "content_id"], "left"))

    def plus(a: str, b: str):
        return (F.col(a) + F.coalesce(F.col(b), F.lit(0))).cast("long")

    out = out.withColumns({"answered_correctly_sum_u": plus("answered_correctly_sum_u", "_s"), "count_u": plus("count_u", "_n"),
                           "part_sum_u": plus("part_sum_u", "_ps"), "part_count_u": plus("part_count_u", "_pn"),
                           "first_time": F.when(F.col("_seen"), F.lit(0)).otherwise(F.col("first_time"))})
    return out.withColumns({"answered_correctly_avg_u": ratio("answered_correctly_sum_u", "count_u"),
                            "part_avg_u": ratio("part_sum_u", "part_count_u")})


def write_batches(batches: DataFrame, folder: str, arranged: bool = False) -> str:
    """The batches as files of a folder that a file stream reads: one write,
    spread over tasks by batch number (``arranged``: as they are already). In
    production batches come from the source."""
    rows = batches if arranged else batches.repartitionByRange("group_num", "row_id")
    rows.write.mode("append").parquet(f"{folder}/in")
    return f"{folder}/in"


def run_late_labels(spark: SparkSession, batches: DataFrame, questions: DataFrame, base: str,
                    init: State | None = None) -> DataFrame:
    """Drive the batches through a file stream and return the written features."""
    stream = spark.readStream.schema(TEST_BATCHES).parquet(write_batches(batches, base))
    scorer = LateLabelScorer(spark, base, questions, init)
    q = (stream.writeStream.foreachBatch(scorer).option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select(*FEATURE_COLS)


def batch_filter(stream: DataFrame, group: int) -> DataFrame:
    """stream_batch_filter: one scoring batch by group number."""
    return stream.filter(F.col("group_num") == group)


__all__ = ["LateLabelScorer", "run_late_labels", "batch_filter", "FEATURE_COLS"]
