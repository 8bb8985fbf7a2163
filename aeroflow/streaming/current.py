"""One message per airport and change, from a topic that sends airports again and again."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from aeroflow import schemas
from aeroflow.operators import decode, flatten
from aeroflow.streaming.ingest import MESSAGE_POSITION, REJECTS, REJECTS_TABLE, Job

# An airport that is not heard of for so long is forgotten.
KEPT_MS = 7 * 24 * 3600 * 1000

_PLACE = ["at", "partition", "offset"]
_OUT = "_id string, key binary, value string, topic string, partition int, offset bigint, at bigint"
_OUT_NAMES = [c.split()[0] for c in _OUT.split(", ")]
_STATE = "at bigint, partition int, offset bigint, digest string"


def changed_documents(records: DataFrame, fields: Iterable[str], kept_ms: int = KEPT_MS) -> DataFrame:
    """Messages of a stream that are newer than all of their ``_id`` before, and say something else.

    What was said last is kept for each ``_id``: the position of its newest message and a digest of
    the given document ``fields``. A message that repeats it only moves the position on, so
    re-sends in any batch, also after a restart, give nothing. An ``_id`` that is not heard of for ``kept_ms`` is
    forgotten, so the state holds the airports of that time and not all there ever were;
    a re-send after it gives one row again, which readers of the newest row do not see. Time is that of
    the micro-batches, not of the messages: no message is ever too late.
    Messages without ``_id`` are left to the airport job.
    """
    fields = list(fields)
    parsed = decode.with_id(decode.parse_airports(records, fields))
    said = parsed.select(
        "_id", "key", F.to_json(F.struct(*fields)).alias("value"), "topic", "partition", "offset",
        F.unix_micros("timestamp").alias("at"), F.current_timestamp().alias("seen"),
    ).withWatermark("seen", "0 seconds").withColumns({"digest": F.sha2("value", 256), "seen_ms": F.unix_millis("seen")})

    def newest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = pd.concat([f.sort_values(_PLACE).tail(1) for f in frames]).sort_values(_PLACE).tail(1)
        place, digest = tuple(int(last[c].iloc[0]) for c in _PLACE), last["digest"].iloc[0]
        before = state.get if state.exists else None
        if before is None or place > tuple(before[:3]):
            state.update((*place, digest))
            if before is None or digest != before[3]:
                yield last[_OUT_NAMES]
        state.setTimeoutTimestamp(int(last["seen_ms"].iloc[0]) + kept_ms)

    found = said.groupBy("_id").applyInPandasWithState(newest, _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    values = {"value": F.col("value").cast("binary"), "timestamp": F.timestamp_micros("at")}
    return found.withColumns(values).select(*schemas.MESSAGE_FIELDS)


def _tables(parsed: DataFrame) -> dict[str, DataFrame]:
    return {"airports": flatten.flatten_airports(parsed, *MESSAGE_POSITION)}


def current_job(kept_ms: int = KEPT_MS) -> Job:
    """A job that appends an airports row only when the airport is new or has changed.

    Readers still take the newest row of each ``_id`` (``ingest.current_airports``): a changed
    airport has a row for each change.
    """
    fields = flatten.AIRPORT_ROW_FIELDS
    return Job(
        "current",
        lambda records: decode.parse_airports(changed_documents(records, fields, kept_ms), fields),
        lambda: {"airports": F.count("_id"), REJECTS: F.count(F.lit(None))},
        dict,
        _tables,
        lambda parsed: parsed.sparkSession.createDataFrame([], schemas.ddl_row(REJECTS_TABLE)),
    )
