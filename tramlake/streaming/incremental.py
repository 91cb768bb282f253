"""Watermarks of incremental transformations: what a node has done already, and what it may begin with."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from tramlake.functions.time import floor, moment, period

EPOCH = datetime(1970, 1, 1)
STEP = timedelta(seconds=1)


def unseen(source: DataFrame, output: DataFrame, time: str) -> DataFrame:
    """Source rows strictly after the newest output row, tombstones included; all rows where there is no output."""
    newest = output.select(F.max(time))
    return source.where(F.col(time) > F.coalesce(newest.scalar(), moment(EPOCH)))


def starting_watermark(source: DataFrame, output: DataFrame | None, required: Sequence[DataFrame], optional: Sequence[DataFrame], time: str) -> DataFrame:
    """One row, column watermark: the newest output, else a second before the first source row, else the epoch; and not
    earlier than a second before the first row of any dependency. No row while a required dependency is empty."""
    before = F.expr("INTERVAL '1' SECOND")
    first = lambda df: df.select(F.min(time) - before).scalar()
    epoch = moment(EPOCH)
    done = [output.select(F.max(time)).scalar()] if output is not None else []
    own = F.coalesce(*done, first(source), epoch)
    bounds = [first(d) for d in required]
    one = source.sparkSession.range(1).select(F.greatest(own, *bounds, *(F.coalesce(first(d), epoch) for d in optional)).alias("watermark") if bounds or optional else own.alias("watermark"), *(b.alias(f"__r{k}") for k, b in enumerate(bounds)))
    for k in range(len(bounds)):
        one = one.where(F.col(f"__r{k}").isNotNull())
    return one.select("watermark")


def plan_range(latest: datetime, size: int | str) -> tuple[datetime, datetime | None, int | None]:
    """(start, end, limit) of the next source slice: a number of rows after the newest output, or a period of time."""
    if isinstance(size, int) or size.isdigit():
        return latest, None, int(size)
    delta = period(size)
    start = floor(latest, delta)
    return start, start + delta, None


Transform = Callable[..., DataFrame]


def next_slice(source: DataFrame, watermark: datetime, size: int | str, strict: bool = True, now: datetime | None = None, time: str = "date") -> DataFrame | None:
    """The next source rows to transform: `size` rows (fewer if lenient) or a whole period; None while they are not there yet."""
    start, end, limit = plan_range(watermark, size)
    if limit is not None:
        rows = source.where(F.col(time) > moment(start)).orderBy(time).limit(limit)
        there = rows.count()
        return rows if there and (there == limit or not strict) else None
    if end > (now or source.agg(F.max(time)).first()[0] or start):
        return None
    return source.where((F.col(time) >= moment(start)) & (F.col(time) < moment(end)))
