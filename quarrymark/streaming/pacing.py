"""A least delay between the requests of a domain: in one pass over what is there, and as a stream that keeps each domain's next free time.

The i-th request of a domain, by time, is sent at the largest of t_j + (i - j) * delay over j up to i: its own time, or a delay after the one before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Seconds between requests to one domain.
DELAY = 0.5
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def paced(rows: DataFrame, key: str, at: str, *ties: str, delay: float = DELAY) -> DataFrame:
    """rows with send_at (timestamp): at or later, and `delay` seconds apart within a key. Rows of equal times go by `ties`; a null time is sent when its
    turn comes after none, so it is null, and a null key is a key."""
    step = int(delay * 1e6)
    taken = {c.lower() for c in rows.columns}
    micros, place = (next(n + "_" * i for i in range(99) if (n + "_" * i) not in taken) for n in ("_micros", "_place"))
    w = Window.partitionBy(key).orderBy(F.col(micros).isNull(), micros, *ties)
    timed = rows.withColumn(micros, F.unix_micros(F.col(at).cast("timestamp"))).withColumn(place, F.row_number().over(w) * F.lit(step).cast("long"))
    ahead = F.max(F.col(micros) - F.col(place)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    sent = F.when(F.col(micros).isNotNull(), F.timestamp_micros(ahead + F.col(place)))
    return timed.withColumn("send_at", sent).drop(micros, place)


class Pacer(StatefulProcessor):
    """Keeps the next free time of a key, until a timer says that it has passed and can't matter any more.

    A batch's rows of one key are sorted together, so a trigger's size bounds what is held; a row that comes in a later batch than one after it is sent
    after that one.
    """

    def __init__(self, columns: list[str], key: str, at: str, ties: tuple[str, ...], delay: float) -> None:
        self.columns, self.key, self.at, self.ties, self.step = columns, key, at, ties, int(delay * 1e6)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.free = handle.getValueState("free", "free bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values([self.at, *self.ties], kind="stable")
        t = batch[self.at].to_numpy("datetime64[us]").astype(np.int64)
        first = self.free.get()[0] if self.free.exists() else -(1 << 62)
        steps = np.arange(len(t)) * self.step
        send = np.maximum(np.maximum.accumulate(t - steps), first) + steps
        free = int(send[-1]) + self.step
        self.free.update((free,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(free // 1000 + 1)
        yield batch.assign(send_at=pd.to_datetime(send, unit="us"))[[*self.columns, "send_at"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.free.clear()
        yield from ()

    def close(self) -> None:
        pass


def paced_stream(stream: DataFrame, key: str, at: str, *ties: str, delay: float = DELAY, late: str = "10 minutes") -> DataFrame:
    """paced() of a stream: what one run leaves off the next goes on with. Rows later than the watermark are dropped, as its users say; state is kept
    in RocksDB, so the session's state store is set to it. Null times come out at once, with a null send_at."""
    stream.sparkSession.conf.set(_STORE, _ROCKS)
    own = stream.withColumn(at, F.col(at).cast("timestamp")).filter(F.col(at).isNotNull()).withWatermark(at, late)
    kind = ", ".join(f"`{c}` {t}" for c, t in own.dtypes) + ", send_at timestamp"
    return own.groupBy(key).transformWithStateInPandas(Pacer(own.columns, key, at, ties, delay), kind, "Append", "EventTime")
