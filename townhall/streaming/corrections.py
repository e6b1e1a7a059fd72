"""First-wins dedupe of a stream with corrections.

The first copy of a key is passed on at once; an earlier copy that comes later is passed on as a correction. What
is kept of a key is one row, for as long as copies may still come: an event-time timer drops it ``delay`` after the
last copy that changed it. A key whose copies are further apart than that starts anew.

Copies of a hot key, one with more than ``_HOT`` rows among those that a task reads at once, are first settled within
``_SPREAD`` salted groups, each of which passes on its own first copy and corrections; only those meet at the key. All
other keys are looked up once a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from townhall.session import DEFAULTS

_SPREAD, _HOT = 8, 256

# settings under which the state, which has timers, can be kept; those of ``build_session`` include them
STORE = {"spark.sql.streaming.stateStore.providerClass": DEFAULTS["spark.sql.streaming.stateStore.providerClass"]}


def _first(order: str, event_time: str, delay_ms: int, names: list[str]) -> StatefulProcessor:
    """The processor. Its class is made here, so that it is sent whole: the worker that Spark starts beside the driver
    for it knows no ``--py-files``."""
    passed = Row(*names, "correction")

    class First(StatefulProcessor):
        """Keeps the place of a key's first copy in the order, and since when."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self._handle = handle
            self._first = handle.getValueState("first", StructType([
                StructField("place", LongType()), StructField("ends", LongType())]))

        def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            best = min((r for r in rows if r[order] is not None), key=lambda r: r[order], default=None)
            held = self._first.get()
            if best is None or held is not None and held[0] <= best[order]:
                return
            before = held[1] if held is not None else None
            ends = before
            if best[event_time] is not None:  # a copy without a time does not say when to forget it
                ends = int(best[event_time].timestamp() * 1000) + delay_ms
                ends = ends if before is None else max(ends, before)
            self._first.update((best[order], ends))
            if ends != before:
                if before is not None:
                    self._handle.deleteTimer(before)
                self._handle.registerTimer(ends)
            yield passed(*[best[n] for n in names], held is not None)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            self._first.clear()
            return iter(())

        def close(self) -> None:
            pass

    return First()


def _marked(stream: DataFrame, key: str) -> DataFrame:
    """With ``_hot``: whether the row's key has more than ``_HOT`` rows among those read with it."""
    most = _HOT

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            hot = np.bincount(codes)[codes] > most if len(codes) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hot)], names=[*batch.schema.names, "_hot"])

    return stream.mapInArrow(mark, StructType([*stream.schema, StructField("_hot", BooleanType())]))


def _settled(stream: DataFrame, key: list[str], order: str, event_time: str, delay_ms: int, names: list[str]) -> DataFrame:
    schema = StructType([*(stream.schema[n] for n in names), StructField("correction", BooleanType())])
    return stream.groupBy(*key).transformWithState(
        _first(order, event_time, delay_ms, names), outputStructType=schema, outputMode="append",
        timeMode="eventTime", eventTimeColumnName=event_time)


def first_with_corrections(
    stream: DataFrame, key: str, order: str, event_time: str, spread_by: Column, delay_ms: int = 86_400_000,
    late: str = "1 day",
) -> DataFrame:
    """Rows of ``stream`` that were a key's first copy when they came, with ``correction`` where they replace one.

    ``order`` is a whole number, the smallest wins; ``spread_by`` differs between copies. Rows later than ``late``
    are dropped. The last row passed on for a key, that of the smallest ``order``, is its first copy. The job is
    to be started under the settings of ``STORE``.
    """
    names = stream.columns
    rows = _marked(stream, key).withWatermark(event_time, late)
    salt = F.pmod(F.xxhash64(spread_by), F.lit(_SPREAD)).cast("long")
    thinned = _settled(rows.where("_hot").withColumn("_salt", salt), [key, "_salt"], order, event_time, delay_ms, names)
    met = rows.where("not _hot").select(*names).unionByName(thinned.drop("correction"))
    return _settled(met, [key], order, event_time, delay_ms, names)
