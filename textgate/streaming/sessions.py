"""Sessions of a stream end at their quit word, however its turns arrive.

The state of a conversation is the number of the turn that is due, whether it has ended, and the turns
that came too early. A question goes out once all turns before it have been seen, so none goes out
that an earlier quit word, still on its way, would have cut off: the stream gives the rows of
``operators.clean.end_sessions``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from textgate.operators.clean import CONTROL_WORDS, drop_blank_asks, drop_control_words, is_control_word
from textgate.functions.text import is_blank, strip
from textgate.streaming.questions import start_sink

#: Kinds of a turn: nothing to answer, a question, the end.
PASS, ASK, QUIT = 0, 1, 2
PROVIDER, ROCKSDB = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Sessions(StatefulProcessor):
    """Questions of one conversation in turn order, up to its quit word.

    ``first`` is the number of a conversation's first turn. With ``wait`` (milliseconds) a turn that is
    missing for so long is given up, and the next one that is held goes out; without it, it is waited
    for. ``keep`` (milliseconds) drops the state of conversations that were silent for so long.
    """

    def __init__(self, first: int = 0, wait: int | None = None, keep: int | None = None) -> None:
        self.first, self.wait, self.keep = first, wait, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", "due long, ended boolean", self.keep)
        self.early = handle.getMapState("early", "turn long", "kind int, text string", self.keep)

    def _go_on(self, due: int, came: dict[int, tuple[int, str]]) -> Iterator[pd.DataFrame]:
        """Take turns from ``due`` on, of those that came and those held, as far as they reach."""
        out, ended = [], False
        while not ended:
            turn = came.pop(due, None)
            if turn is None:
                if not self.early.containsKey((due,)):
                    break
                turn = self.early.getValue((due,))
                self.early.removeKey((due,))
            kind, text = turn
            ended = kind == QUIT
            if kind == ASK:
                out.append((due, text))
            due += 1
        self.place.update((due, ended))
        if ended:
            self.early.clear()
        for turn, value in () if ended else came.items():
            self.early.updateValue((turn,), value)
        yield pd.DataFrame(out, columns=["turn", "text"])

    def _key(self, key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                frame.insert(0, "conv", key[0])
                yield frame

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        due, ended = self.place.get() if self.place.exists() else (self.first, False)
        came: dict[int, tuple[int, str]] = {}
        for frame in rows:
            for turn, kind, text in zip(frame["turn"].tolist(), frame["kind"].tolist(), frame["text"].tolist()):
                if not ended and turn >= due:  # an earlier one has been here before
                    came.setdefault(int(turn), (int(kind), text))
        if ended:
            return
        yield from self._key(key, self._go_on(due, came))
        self._set_timer(timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        due, ended = self.place.get() if self.place.exists() else (self.first, False)
        held = [t[0] for t in self.early.keys()]
        if held and not ended:
            yield from self._key(key, self._go_on(min(held), {}))
        self._set_timer(timerValues)

    def _set_timer(self, timers) -> None:
        if self.wait is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            if next(iter(self.early.keys()), None) is not None:
                self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.wait)

    def close(self) -> None:
        pass


def end_sessions_stream(stream: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text", role: str | None = None,
                        speaker: str = "user", words: Sequence[str] = CONTROL_WORDS, first: int = 0, wait: int | None = None,
                        keep: int | None = None) -> DataFrame:
    """(``conv``, ``turn``, ``text``) of a stream's questions that stand before the first quit word of their
    conversation; blank ones are left out, texts stripped.

    The stream brings all turns of a conversation, each once or more, in any order; with ``role``, only
    those of ``speaker`` are questions. Rows without a conversation or a turn number belong to no
    session: they are kept unless blank or a quit word.
    """
    said = F.coalesce(F.col(role) == speaker, F.lit(False)) if role else F.lit(True)
    kind = F.when(~said | is_blank(text), PASS).when(is_control_word(text, words), QUIT).otherwise(ASK)
    placed = F.col(conv).isNotNull() & F.col(turn).isNotNull()
    schema = T.StructType([T.StructField("conv", stream.schema[conv].dataType), T.StructField("turn", T.LongType()), T.StructField("text", T.StringType())])
    mode = "None" if wait is None and keep is None else "ProcessingTime"
    out = stream.filter(placed).select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), kind.alias("kind"),
                                       F.coalesce(strip(text), F.lit("")).alias("text")) \
        .groupBy("conv").transformWithStateInPandas(Sessions(first, wait, keep), schema, "Append", mode)
    loose = drop_control_words(drop_blank_asks(stream.filter(~placed & said), text), text, words) \
        .select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(text).alias("text"))
    return out.unionByName(loose).toDF(conv, turn, text)


def stream_sessions(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, role: str | None = "role", once: bool = True,
                    glob: str | None = None, max_files_per_trigger: int | None = None, fmt: str = "parquet", **options) -> StreamingQuery:
    """Conversation files → questions before each session's end → append sink. State is kept in RocksDB
    (which ``transformWithState`` needs), with changes logged to ``checkpoint``. ``wait`` and ``keep`` need
    a query that goes on (``once=False``): one that drains what is there would wait for its timers forever."""
    if once and (options.get("wait") is not None or options.get("keep") is not None):
        raise ValueError("wait and keep need once=False")
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:  # a query keeps the settings it was started with
        return start_sink(end_sessions_stream(r.load(source), role=role, **options), sink, checkpoint, once)
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
