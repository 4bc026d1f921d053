"""Repair of the new-visitor flag on a stream, with keyed state.

Two forms. ``repair_visitor_stream`` keeps the date of each device in the state
store and suits steady feeds. ``visitor_batches`` keeps the dates in a table and
repairs each micro-batch with the chunked batch form, so a device that fills a
large part of a batch (a backlog, a bot) is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemart.functions.dates import DAY_MS, ts_to_date
from tidemart.operators.visitor import repair_visitors, visitor_states
from tidemart.sinks.state_table import StateTable

KEYED = -1  # lane of records that meet the state
LANES = 1024
COLUMNS = ["mid", "seq", "ts", "is_new", "value"]
def step(
    is_new: np.ndarray, day: np.ndarray, eve: np.ndarray, state: str | None, rule: str
) -> tuple[np.ndarray, str | None]:
    """Flags and the next state after some records of one device, in order."""
    one = is_new == "1"
    if rule == "as_documented":
        first = state or (day[0] if one[0] else eve[0])
        return np.where(one & (day != first), "0", is_new), first
    start = 0
    if not state:
        if not one.any():
            return is_new, None
        start = int(one.argmax())
        state = day[start]
        start += 1
    # Last flag-0 record before each position, then the date it left behind.
    zero_at = np.where(one[start:], -1, np.arange(start, len(one)))
    latest = np.maximum.accumulate(np.concatenate(([-1], zero_at)))
    before = np.where(latest >= 0, eve[latest], state)
    out = is_new.copy()
    out[start:] = np.where(one[start:] & (day[start:] != before[:-1]), "0", is_new[start:])
    return out, before[-1]


class VisitorProcessor(StatefulProcessor):
    """One date per device; ``ttl_ms`` forgets devices that stay away (off by default)."""

    def __init__(self, rule: str = "as_coded", ttl_ms: int | None = None):
        self.rule = rule
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("d", T.StringType())])
        self.state = handle.getValueState("visit", schema, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        if key[1] != KEYED:
            for part in rows:
                yield part[COLUMNS]
            return
        batch = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable")
        known = self.state.get()
        old = known[0] if known else None
        flags, new = step(
            batch["is_new"].to_numpy(dtype=object),
            batch["day"].to_numpy(dtype=object),
            batch["eve"].to_numpy(dtype=object),
            old,
            self.rule,
        )
        if new and new != old:
            self.state.update((new,))
        yield batch.assign(is_new=flags)[COLUMNS]

    def close(self) -> None:
        pass


def repair_visitor_stream(
    df: DataFrame, rule: str = "as_coded", tz: str = "UTC", ttl_ms: int | None = None
) -> DataFrame:
    """``df(mid, seq, ts, is_new, value)`` with ``is_new`` rewritten.

    Records of a device are ordered by ``seq``, a number or a text, inside a micro-batch; the source's
    per-trigger limit bounds how many there can be. Records without a device or a
    time pass through unchanged, over many lanes so that they do not pile up.
    """
    usable = F.col("mid").isNotNull() & F.col("ts").isNotNull()
    lane = F.when(usable, KEYED).otherwise(F.pmod(F.xxhash64("seq"), F.lit(LANES))).cast("int")
    dated = df.select(
        *COLUMNS,
        lane.alias("lane"),
        ts_to_date(F.col("ts"), tz).alias("day"),
        ts_to_date(F.col("ts") - F.lit(DAY_MS), tz).alias("eve"),
    )
    return dated.groupBy("mid", "lane").transformWithStateInPandas(
        statefulProcessor=VisitorProcessor(rule, ttl_ms),
        outputStructType=T.StructType([df.schema[c] for c in COLUMNS]),
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None",
    )


def visitor_batches(out_path: str, state_path: str, buckets: int = 32, **options):
    """A ``foreachBatch`` function for ``(mid, is_new, ts, seq, ...)`` rows.

    A batch reads the states of its devices' buckets, writes its rows into a folder
    named by its id and then its states. A replay of a batch whose states are
    there does nothing; of any other it writes the same rows again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table = StateTable(batch.sparkSession, state_path, ["mid"], buckets)
        if table.applied(batch_id):
            return
        rows = batch.persist()
        try:
            initial = table.read(of=rows.select("mid").filter("mid IS NOT NULL"))
            fixed = repair_visitors(rows, initial=initial, **options)
            fixed.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
            table.put(visitor_states(rows, initial=initial, **options), batch_id, ["d"])
        finally:
            rows.unpersist()

    return write
