"""Delivery buffers that flush by size or by time, whichever comes first.

Each buffer holds three numbers of state: its flush, the bytes gathered in it and when it has to go. Records are
spread over the buffers by the caller, as a delivery stream spreads them over shards; a buffer is filled by
one task in the records' order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Fixed values of the delivery settings.
MAX_BYTES = 5 * 1024 * 1024
MAX_SECONDS = 60


class Buffers(StatefulProcessor):
    """Numbers each buffer's flushes. A record belongs to the open flush; the flush closes with the record that
    fills it, or when its time is up."""

    def __init__(self, order: str, max_bytes: int, max_seconds: float):
        self.order, self.max_bytes, self.max_ms = order, max_bytes, int(max_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("buffer", "flush long, bytes long, due long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(rows).sort_values(self.order, kind="stable", ignore_index=True)
        flush, held, due = self.state.get() if self.state.exists() else (0, 0, 0)
        flushes = []
        for size, now in zip(batch["size"].tolist(), batch["arrived"].tolist(), strict=True):
            if due and now >= due:
                flush, held, due = flush + 1, 0, 0
            due = due or now + self.max_ms
            flushes.append(flush)
            held += size
            if held >= self.max_bytes:
                flush, held, due = flush + 1, 0, 0
        self.state.update((flush, held, due))
        yield pd.DataFrame({"buffer": key[0], self.order: batch[self.order], "size": batch["size"], "flush": flushes})

    def close(self) -> None:
        pass


def flushes(records: DataFrame, order: str, max_bytes: int = MAX_BYTES, max_seconds: float = MAX_SECONDS) -> DataFrame:
    """``buffer, <order>, size, flush`` of every record of a stream with the columns buffer, ``order`` and size.

    Flushes are numbered from 0 in each buffer. Within a micro-batch records are taken by ``order``; all have the
    batch's time of arrival. That a flush's time was up shows with the first record after it, which needs no
    timer (with processing-time timers an ``availableNow`` run would never end). State is one small row per
    buffer, however long the stream runs; a null size counts as 0.
    """
    kind = records.schema[order].dataType.simpleString()
    slim = records.selectExpr("CAST(buffer AS LONG) AS buffer", order, "CAST(COALESCE(size, 0) AS LONG) AS size",
                              "unix_millis(current_timestamp()) AS arrived")
    return slim.groupBy("buffer").transformWithStateInPandas(
        statefulProcessor=Buffers(order, max_bytes, max_seconds), outputStructType=f"buffer long, {order} {kind}, size long, flush long",
        outputMode="Append", timeMode="None")
