"""Running user callables over records, batch by batch inside Spark tasks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from litsieve.session import small_batches


@dataclass(frozen=True)
class CallPolicy:
    """Pacing and retry of calls.

    ``concurrency`` bounds the tasks that call at the same time, ``min_interval``
    is the pause between calls of one task, and a call that ``is_retryable``
    repeats up to ``max_attempts`` times with a linearly growing pause.
    ``rate`` bounds the calls per second of all tasks together: each of the
    ``concurrency`` tasks gets an equal share and starts in its own part of the interval.
    """

    concurrency: int | None = None
    min_interval: float = 0.0
    max_attempts: int = 1
    backoff: float = 0.0
    is_retryable: Callable[[Exception], bool] = lambda error: True
    rate: float | None = None

    def __post_init__(self):
        if self.rate is not None and not (self.rate > 0 and self.concurrency):
            raise ValueError("a rate over all tasks must be positive and needs a concurrency")

    @property
    def interval(self) -> float:
        """Seconds between two calls of one task."""
        return max(self.min_interval, self.concurrency / self.rate if self.rate else 0.0)


def _before_first(policy: CallPolicy) -> float:
    """Time of a call that would let this task make its first one now, or in its turn under a shared rate."""
    task = TaskContext.get()
    turn = task.partitionId() / policy.rate if policy.rate and task else 0.0
    return time.monotonic() - policy.interval + turn


def call_with_policy(call: Callable[[Any], Any], argument: Any, policy: CallPolicy, last: list[float]) -> Any:
    """Call, pace and repeat; ``last`` holds the time of the task's latest call, and is empty before the first."""
    if not last:
        last.append(_before_first(policy))
    for attempt in range(1, policy.max_attempts + 1):
        pause = policy.interval - (time.monotonic() - last[0])
        if pause > 0:
            time.sleep(pause)
        last[0] = time.monotonic()
        try:
            return call(argument)
        except Exception as error:
            if attempt == policy.max_attempts or not policy.is_retryable(error):
                raise
            time.sleep(policy.backoff * attempt)


def call_records(
    records: DataFrame,
    name: str,
    columns: list[str],
    result: str,
    call: Callable[[dict], dict],
    policy: CallPolicy = CallPolicy(),
) -> DataFrame:
    """Add a struct column ``name`` with the fields of ``result`` from ``call(record)``.

    Only the columns the callable needs travel to Python, as Arrow batches; the
    rest of the record stays where it is, so nothing is shuffled or joined back.
    The call counts as nondeterministic: Spark then makes it once per record.
    """
    fields = [part.split()[0] for part in result.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: list[float] = []
        for batch in batches:
            replies = [call_with_policy(call, record, policy, last) for record in batch.to_dict("records")]
            yield pd.DataFrame([[reply.get(f) for f in fields] for reply in replies], columns=fields)

    struct_type = ", ".join(f"{part.split()[0]}: {part.split()[1]}" for part in result.split(","))
    udf = F.pandas_udf(run, f"struct<{struct_type}>").asNondeterministic()
    small_batches(records)
    source = records.repartition(policy.concurrency) if policy.concurrency else records
    return source.withColumn(name, udf(F.struct("seq", *[c for c in columns if c != "seq"])))
