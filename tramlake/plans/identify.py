"""Vehicle identification: which observations along a line are the same vehicle.

Observations of a line and direction are put on a 0 to 1 scale in time and distance and joined to trips greedily, the best pair
first. Strange trips are split at outlying speeds and trips that continue each other are merged. Groups are independent; a group
must fit one task, which a bounded number of snapshots a run sees to. A task reads its groups in order, as Arrow batches of many groups;
in a group, a trip is only compared with the observations of the next minutes, and each try is kept until its observation is taken.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from hashlib import md5
from heapq import heappop, heappush
from math import atan, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tramlake.functions import geo, text
from tramlake.operators import matching

# Fixed values of the matching rules. The caps look like km/h but are compared with metres a second.
GAP_SECONDS, BACKWARD_METRES, STALE_METRES, STALE_PENALTY, STALE_POINTS = 300.0, 40.0, 0.0, 2.0, 5
Z_LIMIT, LEAST_PART, CONFIDENCE = 4.0, 3, 0.75

RESULT = "lineId string, direction int, row_id bigint, uuid string"


@lru_cache(maxsize=4096)
def student_quantile(p: float, df: int) -> float:
    """Student's t for whole degrees of freedom, by bisection of its finite sums."""

    def share(t: float) -> float:
        """Probability of lying between -t and t."""
        angle = atan(t / sqrt(df))
        c2 = 1 / (1 + t * t / df)
        if df % 2:
            term, total = sqrt(c2), 0.0
            for k in range(1, df, 2):
                total += term
                term *= c2 * (k + 1) / (k + 2)
            return 2 / pi * (angle + t / sqrt(df + t * t) * total)
        term, total = 1.0, 0.0
        for k in range(0, df, 2):
            total += term
            term *= c2 * (k + 1) / (k + 2)
        return t / sqrt(df + t * t) * total

    low, high = 0.0, 1e9
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if share(middle) < 2 * p - 1 else (low, middle)
    return (low + high) / 2


class Group:
    """The observations of a line and direction, in time order, and their trips as lists of observation numbers in time order."""

    def __init__(self, line: str, seconds: np.ndarray, metres: np.ndarray, known: list[str | None], compat: bool = False):
        self.line, self.compat = line, compat
        self.time_scale, self.way_scale = float(np.ptp(seconds)), float(np.ptp(metres))
        self.t = (seconds - seconds.min()) / self.time_scale if self.time_scale else np.zeros(len(seconds))
        self.d = (metres - metres.min()) / self.way_scale if self.way_scale else np.zeros(len(metres))
        kind = "metro" if line.isdigit() and int(line) in text.METRO else "tram" if line.isdigit() and int(line) in text.TRAM else "bus"
        self.metro, self.cap = kind == "metro", text.MAX_SPEED[kind]
        self.trips: list[list[int]] = []
        self.names: list[str | None] = []
        for name in dict.fromkeys(k for k in known if k is not None):
            self.trips.append([i for i, k in enumerate(known) if k == name])
            self.names.append(name)
        self.open = np.array([k is None for k in known])
        self.times = self.t.tolist()
        # Beyond it no observation can be next: the gap, the normalised time that is added to it, and room for rounding.
        self.reach = (GAP_SECONDS + 2) / self.time_scale + 1e-12 if self.time_scale else 0.0

    def start(self, first: int) -> None:
        self.trips.append([first])
        self.names.append(None)
        self.open[first] = False

    def stale(self, trip: list[int]) -> bool:
        return len(trip) >= STALE_POINTS and (self.d[trip[-1]] - self.d[trip[0]]) * self.way_scale < STALE_METRES

    def best(self, trip: list[int]) -> tuple[float, int]:
        """The least score of an open observation as the trip's next, and which; infinite and -1 where there is none."""
        now = self.times[trip[-1]]
        low = bisect_right(self.times, now)
        part = slice(low, bisect_right(self.times, now + self.reach, low))
        if part.start == part.stop:
            return np.inf, -1
        later, further = self.t[part] - now, self.d[part] - self.d[trip[-1]]
        seconds, metres = later * self.time_scale, further * self.way_scale
        with np.errstate(divide="ignore", invalid="ignore"):
            speed = np.where(seconds > 0, metres / np.where(seconds > 0, seconds, 1), 0)
        # The normalised time is added to the gap, as the rules have it.
        fits = self.open[part] & (later > 0) & (seconds <= now + GAP_SECONDS) & (further >= -BACKWARD_METRES / (self.way_scale or 1)) & (seconds != 0) & (speed <= self.cap)
        scores = np.where(fits, (np.abs(further) + later) * (STALE_PENALTY if self.stale(trip) else 1.0), np.inf)
        at = int(scores.argmin())
        return (float(scores[at]), low + at) if scores[at] < np.inf else (np.inf, -1)

    def match(self) -> None:
        if not self.trips:
            first = np.flatnonzero(self.open & (self.t == 0))
            for i in first[::2] if self.compat else first:  # compat seeds every other one
                self.start(int(i))
        # Each trip's best, which holds until its observation is taken; then all trips that wanted it look again.
        tries: list[tuple[float, int, int]] = []
        wanted: dict[int, list[int]] = {}

        def look(k: int) -> None:
            score, i = self.best(self.trips[k])
            if i >= 0:
                heappush(tries, (score, i, k))
                wanted.setdefault(i, []).append(k)

        for k in range(len(self.trips)):
            look(k)
        left, at = int(self.open.sum()), 0
        while left:
            while tries and not self.open[tries[0][1]]:
                heappop(tries)
            if tries:
                _, taken, k = tries[0]
                self.trips[k].append(taken)
                self.open[taken] = False
                for j in wanted.pop(taken):
                    look(j)
            else:
                while not self.open[at]:
                    at += 1
                self.start(at)
                look(len(self.trips) - 1)
            left -= 1

    def split(self) -> None:
        for k in range(len(self.trips)):
            trip = self.trips[k]
            if len(trip) < 2 * LEAST_PART:
                continue
            seconds, metres = np.diff(self.t[trip]) * self.time_scale, np.diff(self.d[trip]) * self.way_scale
            speed = np.where((seconds > 0) & (metres > 0), metres / np.where(seconds > 0, seconds, 1), 0)
            if not speed.std():
                continue
            for at in np.flatnonzero(np.abs((speed - speed.mean()) / speed.std()) > Z_LIMIT).tolist():
                if len(trip[at:]) >= LEAST_PART and len(trip[:at]) >= LEAST_PART:
                    self.trips.append(trip[at:])
                    self.names.append(None)
                    trip = self.trips[k] = trip[:at]

    def continued(self, a: list[int], heads: np.ndarray, trips: list[list[int]]) -> list[int]:
        """Which of the trips, with these first observations and none before a's end, continue a."""
        seconds, metres = (self.t[heads] - self.t[a[-1]]) * self.time_scale, (self.d[heads] - self.d[a[-1]]) * self.way_scale
        ahead = ~(metres < -BACKWARD_METRES)
        near = ahead & (seconds < GAP_SECONDS) & (metres / np.where(seconds, seconds, 1) < self.cap)
        if not (ahead & ~near).any():
            return np.flatnonzero(near).tolist()
        x, y = self.t[a], self.d[a]
        spread = ((x - x.mean()) ** 2).sum()
        slope = ((x - x.mean()) * (y - y.mean())).sum() / spread if spread else 0.0
        expected = lambda z: y.mean() + slope * (z - x.mean())
        off = (y - expected(x)).std()
        wide = student_quantile((1 + CONFIDENCE) / 2, len(a) - 1) * off
        inside = lambda b: np.abs(self.d[b] - expected(self.t[b])) <= wide * np.sqrt(1 / len(a) + (self.t[b] - x.mean()) ** 2 / (spread or 1))
        # Few trips have their first observation on the line; only those are followed.
        for k in np.flatnonzero(ahead & ~near & inside(heads)).tolist():
            near[k] = inside(trips[k]).all()
        return np.flatnonzero(near).tolist()

    def merge(self) -> None:
        long = sorted((k for k, trip in enumerate(self.trips) if len(trip) > 1), key=lambda k: self.times[self.trips[k][0]])
        if len(long) < 2:
            return
        trips = [self.trips[k] for k in long]
        heads = np.array([b[0] for b in trips])
        starts = [self.times[b[0]] for b in trips]
        pairs = []
        for i, a in zip(long, trips, strict=True):
            # From here on none begins before a ends.
            low = bisect_left(starts, self.times[a[-1]])
            if low < len(long):
                pairs += [(abs(self.d[a[-1]] - self.d[heads[low + k]]), i, long[low + k]) for k in self.continued(a, heads[low:], trips[low:]) if long[low + k] != i]
        used: set[int] = set()
        for _, i, j in sorted(pairs):
            if not used & {i, j}:
                used |= {i, j}
                self.trips[i] = self.trips[i] + self.trips[j]
                self.trips[j] = []

    def run(self) -> Iterator[tuple[int, str]]:
        """(observation, name of its trip); new trips are named by line, first time and first distance."""
        self.match()
        if not self.metro:
            self.split()
        self.merge()
        for trip, name in zip(self.trips, self.names, strict=True):
            if trip:
                name = name or md5(f"{self.line}|{trip[0]}|{self.t[trip[0]]:.12f}|{self.d[trip[0]]:.12f}".encode()).hexdigest()
                yield from ((i, name) for i in trip)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Batches sorted by the keys, as tables of whole groups with the first row of each and the number of rows."""
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, row: int) -> list:
        return [batch.column(k)[row].as_py() for k in keys]

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if key(held[0], 0) != key(batch, batch.num_rows - 1):
            table = pa.Table.from_batches(held).combine_chunks()
            firsts = first_rows(table, keys)
            yield table.slice(0, firsts[-1]), firsts
            held = table.slice(firsts[-1]).to_batches()
    if held:
        yield (table := pa.Table.from_batches(held).combine_chunks()), [0, table.num_rows]


def first_rows(table: pa.Table, keys: list[str]) -> list[int]:
    """The rows whose keys differ from those of the row before."""
    new = np.arange(table.num_rows) == 0
    for k in keys:
        codes = table.column(k).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new).tolist()


def identify(rows: DataFrame, compat: bool = False, seconds: float | None = None) -> DataFrame:
    """rows: row_id, lineId, direction, timestamp (seconds), distance, uuid (null where not yet known). Adds the uuid of each row.

    `seconds` cuts time into slices that are judged one by one, so that a group does not grow with the table.
    """

    keys = ["lineId", "direction", "slice"]

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, firsts in whole_groups(batches, keys):
            lines, directions, times, known = (table.column(c).to_pylist() for c in ("lineId", "direction", "timestamp", "uuid"))
            at, metres = (table.column(c).to_numpy().astype(float) for c in ("timestamp", "distance"))
            names: list[str] = []
            for a, b in zip(firsts, firsts[1:], strict=False):
                found, given = dict(Group(str(lines[a]), at[a:b], metres[a:b], known[a:b], compat).run()), {*known[a:b]}
                salt = "|".join([str(lines[a]), *("nan" if x is None else str(x) for x in (directions[a], times[a]))])
                own = {x: x if x in given else md5(f"{salt}|{x}".encode()).hexdigest() for x in found.values()}
                names += [own[found[i]] for i in range(b - a)]
            out = table.select(["lineId", "direction", "row_id"])
            yield from out.append_column("uuid", pa.array(names, table.schema.field("lineId").type)).to_batches()

    slim = rows.select("row_id", F.col("lineId").cast("string").alias("lineId"), F.col("direction").cast("int").alias("direction"), "timestamp", "distance", F.col("uuid").cast("string").alias("uuid"))
    part = F.lit(0).cast("long") if seconds is None else F.floor(F.col("timestamp") / seconds)
    # A number of partitions that is given stays; small rows that take long would else be gathered in one task.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*keys, *(F.col(c).asc_nulls_last() for c in ("timestamp", "distance", "row_id"))]
    return slim.withColumn("slice", part).repartition(parts, *keys).sortWithinPartitions(*order).mapInArrow(named, RESULT)


def with_distance(rows: DataFrame, shapes: DataFrame) -> DataFrame:
    """Adds the distance in metres along the line's first shape whose variant is not the row's direction; 0 without a shape."""
    named = shapes.select(text.shape_line_name(F.col("ligne")).alias("__ligne"), F.col("variante").alias("__variante"), F.transform("geometry", geo.to_lambert).alias("__line"), F.monotonically_increasing_id().alias("__at"))
    keys = rows.select("lineId", "direction").distinct()
    lines = matching.first_other(keys, named, {"lineId": "__ligne"}, ("direction", "__variante"), ["__at"]).select(F.col("lineId").alias("__l"), F.col("direction").alias("__d"), "__line")
    joined = rows.join(lines, F.col("lineId").eqNullSafe(F.col("__l")) & F.col("direction").eqNullSafe(F.col("__d")), "left")
    at = F.when(F.col("__line").isNotNull(), geo.project(F.col("__line"), geo.to_lambert(F.col("geometry")))).otherwise(0.0)
    return joined.withColumn("distance", at).drop("__l", "__d", "__line")


def identified(rows: DataFrame, shapes: DataFrame, state: DataFrame | None = None, compat: bool = False) -> DataFrame:
    """Positions (A10 columns and timestamp) with uuid and id. `state`: the last results, whose vehicles go on; their rows are not
    given again. Of rows with equal place and time in a line and direction one is kept."""
    rows = rows.withColumn("uuid", F.lit(None).cast("string")).withColumn("__new", F.lit(True))
    if state is not None:
        rows = rows.unionByName(state.drop("id").withColumn("__new", F.lit(False)), allowMissingColumns=True)
    once = W.partitionBy("lineId", "direction", "geometry", "timestamp").orderBy(F.col("__new"), F.col("pointId"), F.col("distanceFromPoint"))
    rows = rows.withColumn("__first", F.row_number().over(once)).where("__first = 1").drop("__first")
    numbered = with_distance(rows, shapes).withColumn("row_id", F.xxhash64("lineId", "direction", "geometry", "timestamp"))
    found = identify(numbered, compat).select("row_id", F.col("uuid").alias("__uuid"))
    out = numbered.join(found, "row_id").where("__new").withColumn("uuid", F.col("__uuid")).withColumn("id", F.col("__uuid"))
    return out.drop("__uuid", "__new", "row_id", "distance")
