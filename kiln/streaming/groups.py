"""Training batches from a stream of rollout groups (K2, K4): keyed state holds a buffer and emits on an exact count.

The stream has one row a group: ``lane`` (the queue it waits in; lanes fill batches independently, so as many tasks
work as there are lanes), ``group_id``, ``arrival`` (event time), ``usable`` (false: a group removed for constant
rewards, a place-holder) and ``sampler_step``. State holds ids only, fewer than a minibatch's for each lane.

Rules, all in one state machine (``BatchRule``):

* a minibatch leaves when exactly ``groups_per_minibatch`` groups are buffered; ``groups_per_batch`` over substeps and
  minibatches gives that number (one of each: K2's whole batches);
* place-holders either count towards the number and are removed when the minibatch leaves (``placeholders``), or are
  skipped;
* a group sampled more than ``max_steps_off_policy`` training steps before the lane's current step is requeued;
* a buffer that gets no further group for ``gap_seconds`` of event time ends: its groups come back as ``expired``.

Order within a lane: micro-batch, then (arrival, group_id). A row that is later than the watermark's delay is dropped
by Spark before it reaches the buffer, so the delay has to cover the disorder of the queue.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "ids array<long>, usable array<boolean>, minibatches long, last_us long"
ROWS = "rule string, lane long, status string, step long, substep int, minibatch int, position int, group_id long"
_NAMES = [c.split()[0] for c in ROWS.split(", ")]
_READ = ("group_id", "arrival_us", "usable", "sampler_step")
#: Rows of a lane that are Python objects at one time.
BLOCK_ROWS = 20_000


@dataclass(frozen=True)
class BatchRule:
    groups_per_batch: int
    num_substeps: int = 1
    num_minibatches: int = 1
    placeholders: bool = False
    max_steps_off_policy: int | None = None
    gap_seconds: int | None = None

    def __post_init__(self):
        if self.groups_per_batch < 1 or self.groups_per_batch % (self.num_substeps * self.num_minibatches):
            raise ValueError("groups_per_batch must be divisible by num_substeps * num_minibatches")

    @property
    def groups_per_minibatch(self) -> int:
        return self.groups_per_batch // (self.num_substeps * self.num_minibatches)

    def place(self, done: int) -> tuple[int, int, int]:
        """(step, substep, minibatch) of the minibatch that leaves after ``done`` others."""
        step, rest = divmod(done, self.num_substeps * self.num_minibatches)
        return (step, *divmod(rest, self.num_minibatches))


class _Lane:
    """Buffer of one lane while its rows of a micro-batch pass."""

    def __init__(self, name: str, lane: int, rule: BatchRule, held: tuple | None):
        self.name, self.lane, self.rule = name, lane, rule
        self.ids, self.usable, self.done, self.last_us = (list(held[0]), list(held[1]), held[2], held[3]) if held else ([], [], 0, 0)
        self.out: list[tuple] = []

    def _emit(self, status: str, ids: list[int]) -> None:
        at = self.rule.place(self.done)
        self.out.extend((self.name, self.lane, status, *at, i, g) for i, g in enumerate(ids))

    def _take(self) -> list[int]:
        ids = [g for g, ok in zip(self.ids, self.usable, strict=True) if ok]
        self.ids, self.usable = [], []
        return ids

    def expire(self) -> None:
        self._emit("expired", self._take())

    def add(self, group: int, us: int, usable: bool, sampler_step: int) -> None:
        rule = self.rule
        if not usable and not rule.placeholders:
            return
        if self.ids and rule.gap_seconds is not None and us - self.last_us > rule.gap_seconds * 1_000_000:
            self.expire()
        if usable and rule.max_steps_off_policy is not None and rule.place(self.done)[0] - sampler_step > rule.max_steps_off_policy:
            self._emit("requeue", [group])
            return
        self.ids.append(group)
        self.usable.append(usable)
        self.last_us = us
        if len(self.ids) == rule.groups_per_minibatch:
            self._emit("train", self._take())
            self.done += 1

    def taken(self) -> pd.DataFrame:
        rows, self.out = self.out, []
        return pd.DataFrame(rows, columns=_NAMES)

    def pass_rows(self, pdfs: Iterable[pd.DataFrame], block: int = BLOCK_ROWS) -> Iterator[pd.DataFrame]:
        """The rows of a micro-batch in order, with what leaves on the way.

        A lane may hold millions of rows: they are kept as four arrays of numbers (some 60 bytes a row with the sorted
        order), become Python objects a block at a time, and what leaves is handed on after each block."""
        parts = [[f[c].to_numpy() for c in _READ] for f in pdfs]
        group, us, usable, sampler = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        order = np.lexsort((group, us))
        for at in range(0, len(order), block):
            some = order[at : at + block]
            for row in zip(*(c[some].tolist() for c in (group, us, usable, sampler)), strict=True):
                self.add(*row)
            if len(self.out) >= block:
                yield self.taken()


def batch_groups(stream: DataFrame, rules: dict[str, BatchRule], delay: str) -> DataFrame:
    """Rows (rule, lane, status, step, substep, minibatch, position, group_id) of a stream of groups, for each rule."""

    def advance(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        name, lane = str(key[0]), int(key[1])
        rule = rules[name]
        b = _Lane(name, lane, rule, state.get if state.exists else None)
        if state.hasTimedOut:
            b.expire()
        else:
            yield from b.pass_rows(pdfs)
        state.update((b.ids, b.usable, b.done, b.last_us))
        if b.ids and rule.gap_seconds is not None:
            state.setTimeoutTimestamp(max(b.last_us // 1000 + rule.gap_seconds * 1000, state.getCurrentWatermarkMs() + 1))
        if b.out:
            yield b.taken()

    seen = stream.withWatermark("arrival", delay).select(
        "lane", "group_id", "arrival", F.unix_micros("arrival").alias("arrival_us"), "usable", F.col("sampler_step").cast("long").alias("sampler_step"),
        F.explode(F.array(*[F.lit(r) for r in rules])).alias("rule"),
    )
    return seen.groupBy("rule", "lane").applyInPandasWithState(advance, ROWS, STATE, "append", GroupStateTimeout.EventTimeTimeout)
