"""Late labels in Spark's state store (survey 2.11 stream_late_labels).

Batch g of a scoring stream carries the answers of the batch before it, as a
text list that is positional on that batch's rows (D18). Two stateful operators
in one streaming query:

1. ``MatchAnswers``, keyed by batch: the rows of a batch wait in a list until
   its answers come (with the next batch), and then leave the state. A batch is
   what the source serves at once, so the list is bounded by it.
2. ``UserHistory``, keyed by user: total, parts and contents answered so far, as
   a value and two maps. Events of a user are taken in order of batches, answers
   before rows, so a row sees the answers of earlier batches only.

A micro-batch touches the state of the users and batches in it, and reads
nothing of earlier ones: its cost does not grow with the history. State is
committed with the micro-batch (RocksDB state store, checkpoint on shared
storage) and results go to a file sink that commits by micro-batch, so a query
that crashes and starts again folds nothing twice.

Frozen columns by content (statistics, tag components) are joined to the rows
that leave the state. One user's events of one micro-batch are held by a task;
the trigger bounds them.

The features equal a container-grain history with the batch as the container.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

from ..operators.history import part_key
from ..operators.joins import join_dim
from ..operators.prefix import Agg, running
from ..operators.stats import content_stats
from ..session import scratch_path, stored
from .late_labels import FEATURE_COLS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PENDING = "pos long, row_id long, user_id long, content_id int, part_k int, is_question boolean"
EVENTS = "user_id long, group_num long, kind int, row_id long, content_id int, part_k int, answer int"
FEATURES = ("row_id long, user_id long, content_id int, group_num long, answered_correctly_sum_u long, count_u long, "
            "answered_correctly_avg_u double, part_sum_u long, part_count_u long, part_avg_u double, first_time int")
ANSWER, ROW = 0, 1


def positioned(batches: DataFrame) -> DataFrame:
    """What a source knows of each batch that it serves: a row's position, the
    number of the batch before, and once per batch (at position 0) its answers."""
    # the lists stay out of all that is sorted by row: a batch's one is taken apart, by a hash aggregate
    # (on the text as a key), and comes to the first row alone
    rows = running(batches.select("row_id", "user_id", "content_id", "content_type_id", "group_num"), ["group_num"],
                   [Agg("pos", "count", F.lit(1))], order=("row_id",), spread_out=True)
    lists = batches.groupBy("group_num", F.col("prior_group_answers_correct").alias("_list")).agg(F.min("row_id").alias("_row"))
    lists = stored(lists.groupBy("group_num").agg(F.min_by("_list", "_row").alias("_list")), "lists")
    groups = running(lists.select("group_num"), [], [Agg("answers_of", "last", F.col("group_num"))], order=("group_num",))
    first = F.col("pos") == 0
    return (rows.join(groups, "group_num", "left").join(lists, "group_num", "left")
            .select("row_id", "user_id", "content_id", "content_type_id", "group_num", "pos", F.when(first, F.col("answers_of")).alias("answers_of"),
                    F.when(first, F.col("_list")).alias("answers")))


class MatchAnswers(StatefulProcessor):
    """Rows of a batch as they come, and their answers as events when these come."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getListState("waiting", PENDING)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new, answers = [], None
        for r in rows:
            if r.answers is not None:
                answers = (r.delivered, json.loads(r.answers))
                continue
            new.append((r.pos, r.row_id, r.user_id, r.content_id, r.part_k, r.is_question))
            if r.is_question:
                yield Row(user_id=r.user_id, group_num=key[0], kind=ROW, row_id=r.row_id, content_id=r.content_id, part_k=r.part_k, answer=None)
        if answers is None:
            self.waiting.appendList(new)
            return
        delivered, right = answers
        known = [*self.waiting.get(), *new] if self.waiting.exists() else new
        for pos, row_id, user_id, content_id, part_k, is_question in known:
            answer = right[pos] if pos < len(right) else None
            if is_question and answer is not None and answer != -1:
                yield Row(user_id=user_id, group_num=delivered, kind=ANSWER, row_id=row_id, content_id=content_id, part_k=part_k, answer=answer)
        self.waiting.clear()

    def close(self) -> None:
        pass


class UserHistory(StatefulProcessor):
    """A user's questions with what earlier batches' answers add up to."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "s long, n long")
        self.parts = handle.getMapState("parts", "part_k int", "s long, n long")
        self.contents = handle.getMapState("contents", "content_id int", "n long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        total = tuple(self.total.get()) if self.total.exists() else (0, 0)
        before, parts, contents = total, {}, {}
        folded: set[tuple[str, int]] = set()

        def part(k: int) -> tuple[int, int]:
            if k not in parts:
                parts[k] = tuple(self.parts.getValue((k,))) if self.parts.containsKey((k,)) else (0, 0)
            return parts[k]

        def met(k: int) -> int:
            if k not in contents:
                contents[k] = self.contents.getValue((k,))[0] if self.contents.containsKey((k,)) else 0
            return contents[k]

        for e in sorted(rows, key=lambda e: (e.group_num, e.kind, e.row_id)):
            s, n = part(e.part_k)
            if e.kind == ANSWER:
                total = (total[0] + e.answer, total[1] + 1)
                parts[e.part_k] = (s + e.answer, n + 1)
                contents[e.content_id] = met(e.content_id) + 1
                folded |= {("part", e.part_k), ("content", e.content_id)}
            else:
                yield Row(row_id=e.row_id, user_id=key[0], content_id=e.content_id, group_num=e.group_num,
                          answered_correctly_sum_u=total[0], count_u=total[1], answered_correctly_avg_u=total[0] / total[1] if total[1] else None,
                          part_sum_u=s, part_count_u=n, part_avg_u=s / n if n else None, first_time=int(met(e.content_id) == 0))
        if total != before:
            self.total.update(total)
        for kind, k in folded:
            if kind == "part":
                self.parts.updateValue((k,), parts[k])
            else:
                self.contents.updateValue((k,), (contents[k],))

    def close(self) -> None:
        pass


def content_columns(q: DataFrame, questions: DataFrame, components: tuple[int, ...] = (0, 3, 4), k: int = 5) -> DataFrame:
    """By content: statistics of the labelled question rows ``q`` and some tag components of the question table."""
    from ..functions.encoders import TagsEncoder

    names = [f"PCA_{i}" for i in components]
    tags = TagsEncoder(k=k).fit(questions).transform(questions).select(F.col("question_id").alias("content_id"), *names)
    return content_stats(q).join(tags, "content_id", "full")


def late_label_features(stream: DataFrame, questions: DataFrame, content: DataFrame | None = None) -> DataFrame:
    """Features of the question rows of a stream of ``positioned`` batches.

    ``content`` has columns by ``content_id`` that are joined to each row.
    """
    rows = join_dim(stream, questions.select("question_id", "part"), "content_id", "question_id")
    row = F.struct(F.col("group_num").alias("batch"), "pos", "row_id", "user_id", F.col("content_id").cast("int").alias("content_id"), part_key().cast("int").alias("part_k"),
                   (F.col("content_type_id") == 0).alias("is_question"), F.lit(None).cast("string").alias("answers"), F.lit(None).cast("long").alias("delivered"))
    names = ("pos", "row_id", "user_id", "content_id", "part_k", "is_question")
    answers = F.struct(F.col("answers_of").alias("batch"), *(F.lit(None).cast(t).alias(c) for c, t in zip(names, ("long", "long", "long", "int", "int", "boolean"), strict=True)),
                       F.col("answers"), F.col("group_num").alias("delivered"))
    events = rows.select(F.explode(F.when(F.col("answers_of").isNotNull() & F.col("answers").isNotNull(), F.array(row, answers)).otherwise(F.array(row))).alias("e")).select("e.*")
    matched = events.groupBy("batch").transformWithState(MatchAnswers(), EVENTS, "append", "none")
    out = matched.groupBy("user_id").transformWithState(UserHistory(), FEATURES, "append", "none")
    return out if content is None else out.join(content, "content_id", "left")


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the state store that the processors need; the caller's stays as it is."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        if value := spark.conf.get(name, None):
            own.conf.set(name, value)
    return own


def start_late_labels(spark: SparkSession, folder: str, schema, questions: DataFrame, base: str,
                      content: DataFrame | None = None, files_per_trigger: int | None = None):
    """Start the query over the files of ``folder`` (results under ``base``); frozen tables are stored first."""
    own = streaming_session(spark)

    def frozen(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, f"late-{uuid.uuid4().hex}")
        df.write.parquet(path)
        return own.read.parquet(path)

    source = own.readStream.schema(schema)
    if files_per_trigger:
        source = source.option("maxFilesPerTrigger", files_per_trigger)
    out = late_label_features(source.parquet(folder), frozen(questions.select("question_id", "part")), frozen(content) if content is not None else None)
    return (out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
            .trigger(availableNow=True).start())


def run_late_labels_in_state(spark: SparkSession, batches: DataFrame, questions: DataFrame, base: str,
                             content: DataFrame | None = None) -> DataFrame:
    """Drive the batches through a file stream and return the written features."""
    served = positioned(batches)
    served.repartitionByRange("group_num", "row_id").write.mode("append").parquet(f"{base}/in")
    start_late_labels(spark, f"{base}/in", served.schema, questions, base, content).awaitTermination()
    extra = [c for c in (content.columns if content is not None else []) if c != "content_id"]
    return spark.read.parquet(f"{base}/out").select(*FEATURE_COLS, *extra)
