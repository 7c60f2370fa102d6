"""Alert rules evaluated as samples stream in: each (rule, instance) goes from pending to firing and back by event time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from skyroll.operators.monitor import flagged
from skyroll.schema import STALENESS_SECONDS

# States. A pending run that ends is inactive again, a firing one resolved.
PENDING, FIRING, INACTIVE, RESOLVED = "pending", "firing", "inactive", "resolved"

_SERIES = ["alert", "severity", "for_seconds", "instance"]
_OUT = "alert string, severity string, instance string, state string, at timestamp, start_ts timestamp, end_ts timestamp, samples long"


class Run:
    """Consecutive true samples of one series: start, last, number; and the time of the last sample of any kind."""

    def __init__(self, start: int | None, last: int, samples: int, fired: bool) -> None:
        self.start, self.last, self.samples, self.fired = start, last, samples, fired

    def ended(self, at: int) -> tuple:
        out = (RESOLVED if self.fired else INACTIVE, at, self.start, self.last, self.samples)
        self.start, self.samples, self.fired = None, 0, False
        return out

    def step(self, ts: int, flag: bool, hold: int, stale: int) -> Iterator[tuple]:
        """Transitions (state, at, start, end, samples) that a sample makes."""
        if self.start is not None and ts - self.last > stale:
            yield self.ended(self.last + stale)
        if not flag:
            if self.start is not None:
                yield self.ended(ts)
            return
        if self.start is None:
            self.start = ts
            yield PENDING, ts, ts, ts, 1
        self.last, self.samples = ts, self.samples + 1
        if not self.fired and ts - self.start >= hold:
            self.fired = True
            yield FIRING, ts, self.start, ts, self.samples


def live_alerts(samples: DataFrame, rules: DataFrame, watermark: str, staleness_seconds: int = STALENESS_SECONDS) -> DataFrame:
    """Transitions of each (rule, instance): ``state`` pending, firing, inactive or resolved, the event time ``at``
    which it was reached, the run's ``start_ts``, ``end_ts`` (last true sample so far) and number of ``samples``.

    Output mode ``append``. Samples wait in state until the watermark passes
    them and are then taken by (ts, sample_id), so the order of delivery doesn't
    matter; those later than the watermark are dropped. A run without samples
    for ``staleness_seconds`` ends by an event-time timer. Runs that ended equal
    ``alert_rules`` over all samples; a series holds what the watermark hasn't
    passed and one run."""
    stale = staleness_seconds * 1_000_000
    rows = flagged(samples, rules).select(*_SERIES, F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "sample_id",
                                          F.coalesce("_flag", F.lit(False)).alias("flag"), F.col("ts").cast("timestamp").alias("_et"))
    rows = rows.withWatermark("_et", watermark)

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        alert, severity, hold, instance = key
        run, waiting = Run(None, 0, 0, False), []
        if state.exists:
            start, last, n, fired, held = state.get
            run = Run(start, last, n, fired)
            waiting.append(np.frombuffer(held, np.int64).reshape(-1, 3))
        if not state.hasTimedOut:
            waiting += [b[["us", "sample_id", "flag"]].to_numpy(np.int64) for b in batches]
        passed = state.getCurrentWatermarkMs() * 1000
        rest = np.concatenate(waiting) if waiting else np.zeros((0, 3), np.int64)
        rest = rest[np.lexsort((rest[:, 1], rest[:, 0]))]
        ready = int(np.searchsorted(rest[:, 0], passed, side="right"))
        out = [t for us, _, flag in rest[:ready].tolist() for t in run.step(us, bool(flag), int(hold) * 1_000_000, stale)]
        rest = rest[ready:]
        # Nothing can still come at or before the watermark: a run whose staleness it has passed is over.
        if run.start is not None and passed > run.last + stale:
            out.append(run.ended(run.last + stale))
        if run.start is None and not len(rest):
            if state.exists:
                state.remove()
        else:
            state.update((run.start, run.last, run.samples, run.fired, rest.tobytes()))
            due = [int(rest[0, 0])] if len(rest) else []
            due += [run.last + stale + 1] if run.start is not None else []
            state.setTimeoutTimestamp(max(-(-min(due) // 1000), passed // 1000 + 1))
        if out:
            when = lambda i: pd.to_datetime([t[i] for t in out], unit="us")
            yield pd.DataFrame({"alert": alert, "severity": severity, "instance": instance, "state": [t[0] for t in out], "at": when(1),
                                "start_ts": when(2), "end_ts": when(3), "samples": [t[4] for t in out]})

    g = rows.groupBy(*_SERIES).applyInPandasWithState(
        advance, _OUT, "start long, last long, samples long, fired boolean, waiting binary", "append", GroupStateTimeout.EventTimeTimeout)
    return g.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in ("at", "start_ts", "end_ts") else c for c in g.columns])


def ended_runs(transitions: DataFrame) -> DataFrame:
    """The runs that are over, with the columns of ``alert_rules``."""
    seconds = F.timestamp_diff("MICROSECOND", F.col("start_ts"), F.col("end_ts")) / F.lit(1_000_000.0)
    over = transitions.filter(F.col("state").isin(INACTIVE, RESOLVED))
    return over.select("alert", "severity", "instance", "start_ts", "end_ts", "samples", seconds.alias("duration_seconds"),
                       (F.col("state") == RESOLVED).alias("fired"))
