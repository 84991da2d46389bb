"""Documents from pages that arrive in any order and in different batches of a stream, each put together once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructType

OUTPUT = "doc string, status string, pages int, missing int, text string, page int"


class Assembly(StatefulProcessor):
    """Keeps the pages of a document until all are there, or until the watermark is ``patience`` past its first page.

    Emits one row for each document, ``complete`` or ``incomplete``, and a ``late`` row for each page that comes after it.
    That a document is done is remembered for ``memory``; pages older than the watermark never get here.
    """

    def __init__(self, patience: int, memory: int):
        self.patience, self.memory = patience, memory

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.texts = handle.getMapState("texts", StructType().add("page", IntegerType()), StructType().add("text", StringType()))
        self.state = handle.getValueState("state", StructType().add("done", BooleanType()).add("pages", IntegerType()).add("timer", LongType()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        done, pages, timer = self.state.get() or (False, 0, None)
        out = []
        for frame in rows:
            for page, count, text, at in zip(frame["page"], frame["pages"], frame["cleaned"], frame["at"], strict=True):
                if done:
                    out.append((key[0], "late", pages, 0, text, int(page)))
                    continue
                pages = max(pages, int(count))
                self.texts.updateValue((int(page),), (text,))
                when = int(pd.Timestamp(at).timestamp() * 1000) + self.patience
                if timer is None or when < timer:
                    if timer is not None:
                        self.handle.deleteTimer(timer)
                    timer = when
                    self.handle.registerTimer(timer)
        if not done:
            texts = {k[0]: v[0] for k, v in self.texts.iterator()}
            if len(texts) >= pages:
                out.append(self._finished(key, "complete", pages, texts))
                self.handle.deleteTimer(timer)
                done, timer = True, self._remember(timer)
        self.state.update((done, pages, timer))
        if out:
            yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        done, pages, timer = self.state.get()
        if done:
            self.state.clear()
            return
        out = self._finished(key, "incomplete", pages, {k[0]: v[0] for k, v in self.texts.iterator()})
        self.state.update((True, pages, self._remember(timer)))
        yield self._frame([out])

    def _remember(self, timer: int) -> int:
        self.texts.clear()
        self.handle.registerTimer(timer + self.memory)
        return timer + self.memory

    @staticmethod
    def _finished(key, status: str, pages: int, texts: dict) -> tuple:
        text = "\n".join(texts[p] for p in sorted(texts) if texts[p])
        return key[0], status, pages, pages - len(texts), text, None

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=["doc", "status", "pages", "missing", "text", "page"])
        return frame.astype({"pages": "int32", "missing": "int32"}).assign(page=frame["page"].astype("Int32"))

    def close(self) -> None:
        pass


def assemble(pages: DataFrame, delay: str = "10 minutes", patience: int = 3_600_000, memory: int = 86_400_000) -> DataFrame:
    """``OUTPUT`` rows of a stream of pages (doc, page, pages, cleaned, at): the narrative of each document once, in append mode.

    at: the event time; delay: how late a page may be before it is dropped; patience, memory: milliseconds of event time (see
    ``Assembly``).  A page that comes twice counts once, the last text; null and empty texts take part but leave no line.
    The state is kept by RocksDB, which ``state_store`` sets for the session.
    """
    state_store(pages.sparkSession)
    rows = pages.select("doc", "page", "pages", "cleaned", "at").withWatermark("at", delay)
    return rows.groupBy("doc").transformWithStateInPandas(Assembly(patience, memory), OUTPUT, "append", "eventTime")


def state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
