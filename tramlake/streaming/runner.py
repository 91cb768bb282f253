"""Running nodes: collecting, deriving slice by slice with as-of dependencies, and streams over the catalog."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from tramlake.functions.time import moment, schedule
from tramlake.plans.nodes import Node
from tramlake.sources.catalog import Catalog
from tramlake.streaming import incremental

log = logging.getLogger(__name__)
IDLE, AFTER_ERROR, COMPACTION = 5, 60, 60


def collect(catalog: Catalog, node: Node, now: datetime) -> bool:
    """Runs a collector once and appends what it returns, a text or nothing."""
    value = node.load()()
    if value is None:
        return False
    row = catalog.spark.createDataFrame([(now, value)], "date timestamp_ntz, data string")
    catalog.append(node.name, row, node.data_type)
    return True


def dependencies(catalog: Catalog, node: Node, at: datetime) -> dict[str, DataFrame | None]:
    """For each edge the latest rows strictly before a time. Of a required single row that is missing, the latest of all is taken, even a
    later one; a required table without rows is an error, an optional one is None."""
    out: dict[str, DataFrame | None] = {}
    for edges, required in ((node.dependencies, True), (node.optional, False)):
        for name, n in edges:
            rows = catalog.before(name, at, n)
            if rows.isEmpty():
                rows = catalog.latest(name) if required and n == 1 else None
                if required and (rows is None or rows.isEmpty()):
                    raise LookupError(f"{node.name}: {name} has no rows")
            out[name] = rows
    return out


def watermark(catalog: Catalog, node: Node) -> datetime | None:
    """From when on the source is to be read; None while a required dependency is empty."""
    held = catalog.raw(node.name)
    table = lambda edges: [catalog.stored(n).select("date") for n, _ in edges if n != node.name]
    output = held.select("date") if not held.isEmpty() else None
    row = incremental.starting_watermark(catalog.stored(node.source).select("date"), output, table(node.dependencies), table(node.optional), "date").first()
    return row[0] if row else None


def derive(catalog: Catalog, node: Node) -> bool:
    """Transforms the next slice of the source; False if it is not there yet.

    The node's function gets the source rows and its dependencies by name and returns rows of data (and, with several
    results, the date of each). Where no result has the slice's last date, a tombstone marks there that the slice is done.
    """
    start = watermark(catalog, node)
    if start is None:
        return False
    source = catalog.stored(node.source, incremental.plan_range(start, node.source_range)[0])
    rows = incremental.next_slice(source, start, node.source_range, node.strict)
    if rows is None:
        return False
    rows = catalog.resolved(node.source, rows)
    last = rows.agg(F.max("date")).first()[0]
    if last is None:
        _, last, _ = incremental.plan_range(start, node.source_range)
    result = node.load()(rows, **dependencies(catalog, node, last))
    if result is not None and not (node.multiple and "date" in result.columns):
        result = result.select(moment(last).alias("date"), "data")
    done = catalog.spark.createDataFrame([(last, None)], "date timestamp_ntz, data string")
    if result is None or result.isEmpty():
        result = done
    elif node.multiple and result.where(F.col("date") == moment(last)).isEmpty():
        result = result.select("date", "data").union(done)
    catalog.append(node.name, result.select("date", "data"), node.data_type)
    return True


def derive_all(catalog: Catalog, node: Node) -> int:
    """Slices until the source is used up; returns their number."""
    n = 0
    while derive(catalog, node):
        n += 1
    return n


def loop(step: Callable[[], bool], stop: Callable[[], bool], sleep: Callable[[float], object] = time.sleep, idle: float = IDLE) -> None:
    """Repeats a step at once while it does something, after `idle` seconds if not, and after AFTER_ERROR if it failed."""
    while not stop():
        try:
            if not step():
                sleep(idle)
        except Exception:
            log.exception("a step failed")
            sleep(AFTER_ERROR)


def due_times(text: str, start: datetime) -> Iterator[datetime]:
    """When a schedule comes up, from `start` on."""
    plan = schedule(text)
    if "every" in plan:
        at = start + plan["every"]
        while True:
            yield at
            at += plan["every"]
    hour, minute = plan["at"]
    at = start.replace(hour=hour, minute=minute, second=0, microsecond=0)
    while True:
        if at > start:
            yield at
        at += timedelta(days=1)


def stream(snapshots: DataFrame, transform: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str, available_now: bool = True):
    """A streaming query that transforms new snapshots with a batch function. Each micro-batch is written under its number, so
    a batch that runs again replaces itself."""

    def write(rows: DataFrame, number: int) -> None:
        transform(rows).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    writer = snapshots.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{IDLE} seconds")).start()


def tumbling(events: DataFrame, at: str, period: timedelta, keys: list[str], value: str, lateness: timedelta) -> DataFrame:
    """Counts and sums a tumbling window of a stream; rows later than `lateness` behind the newest are dropped."""
    seconds = lambda d: f"{int(d.total_seconds())} seconds"
    # Windows of a week begin on Mondays; the epoch was a Thursday.
    start = "4 days" if period == timedelta(weeks=1) else None
    window = F.window(at, seconds(period), seconds(period), start) if start else F.window(at, seconds(period))
    return events.withWatermark(at, seconds(lateness)).groupBy(window, *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
