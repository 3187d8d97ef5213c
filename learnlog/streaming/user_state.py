"""Running user history over a stream (survey 2.11 stream_user_state).

``groupBy(user_id).applyInPandasWithState`` keeps (sum, count) per user in
Spark's state store (checkpointed, so a restarted query resumes from the
last committed micro-batch). Inside one call a group is one user's rows of
one micro-batch, which is bounded by the trigger size; rows are ordered by
(timestamp, row_id) before the state is folded in.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT_SCHEMA = ("row_id long, user_id long, answered_correctly_sum_u long, count_u long, "
              "answered_correctly_avg_u double")
STATE_SCHEMA = "s long, n long"


def _fold(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    s, n = state.get if state.exists else (0, 0)
    pdf = pd.concat(list(batches), ignore_index=True).sort_values(["timestamp", "row_id"], kind="stable")
    y = pdf["answered_correctly"].astype("int64").to_numpy()
    before = y.cumsum() - y + s
    count = pd.RangeIndex(len(pdf)).to_numpy() + n
    avg = np.divide(before, count, out=np.full(len(pdf), np.nan), where=count > 0)
    state.update((int(s + y.sum()), int(n + len(pdf))))
    yield pd.DataFrame({"row_id": pdf["row_id"].to_numpy(), "user_id": pdf["user_id"].to_numpy(),
                        "answered_correctly_sum_u": before, "count_u": count,
                        "answered_correctly_avg_u": avg})


def stream_user_state(stream: DataFrame) -> DataFrame:
    """Per question row of a streaming log: answered_correctly_sum_u / count_u /
    answered_correctly_avg_u over the user's earlier rows (all batches)."""
    q = stream.filter("content_type_id = 0").select("row_id", "timestamp", "user_id", "answered_correctly")
    return q.groupBy("user_id").applyInPandasWithState(
        _fold, outputStructType=OUT_SCHEMA, stateStructType=STATE_SCHEMA,
        outputMode="append", timeoutConf=GroupStateTimeout.NoTimeout)
