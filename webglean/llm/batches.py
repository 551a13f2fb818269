"""Memory of Python over whole texts: batch size, and what a worker keeps between tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

ROWS = 1000
_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def short_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches hold at most ``ROWS`` rows. Texts are long: batches of
    the usual 10,000 rows would take most of an executor's memory outside of the heap."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_KEY, "10000")) <= ROWS:
        conf.set(_KEY, str(ROWS))
    return df


_kept: dict[str, Callable[[], None]] = {}


def working(operator: str, drop: Callable[[], None] | None = None) -> None:
    """To be called in a task: drops what other operators keep in this worker, which Spark hands from
    stage to stage. ``drop`` frees what this one keeps."""
    for name in [name for name in _kept if name != operator]:
        _kept.pop(name)()
    if drop is not None:
        _kept[operator] = drop
