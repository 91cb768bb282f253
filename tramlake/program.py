"""The program that runs a configuration over one catalog: collecting on schedule, deriving, compacting and answering.

Each node has a thread in the session's driver, where it only plans: the work itself is Spark's. A failure is logged and the thread goes on.

    python -m tramlake CONFIGURATION CATALOG --collect all --derive city_segments --compact all --serve all --port 8888
"""

from __future__ import annotations

import argparse
import logging
import threading
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import SparkSession

from tramlake.plans import compaction, nodes, service
from tramlake.plans.nodes import Node
from tramlake.sources.catalog import Catalog
from tramlake.streaming import runner

log = logging.getLogger(__name__)
KINDS = {"collect": "collectors", "derive": "harvesters", "serve": "handlers"}


def on_schedule(step: Callable[[], object], schedule: str, stop: threading.Event, now: Callable[[], datetime] = datetime.now, wait: Callable[[float], object] | None = None) -> None:
    """Does a step whenever a schedule comes up, until `stop` is set; a step that fails is logged, and times that passed meanwhile are left out."""
    wait = wait or stop.wait
    for at in runner.due_times(schedule, now()):
        if at < now() and not stop.is_set():
            continue
        while not stop.is_set() and (rest := (at - now()).total_seconds()) > 0:
            wait(min(rest, 1.0))
        if stop.is_set():
            return
        try:
            step()
        except Exception:
            log.exception("a scheduled step failed")


def compact(catalog: Catalog, node: Node, folder: str, end: datetime) -> list[tuple[str, datetime]]:
    """Compacts a node's table up to a time; returns what was added."""
    kinds = {"string": "string", "integer": "bigint"}
    item = f"struct<{','.join(f'{n}:{kinds[k]}' for n, k in node.item_types.items())}>"
    key = next((k for _, keys in node.levels for k in keys), None)
    return compaction.Archive(catalog.spark, f"{folder}/{node.name}", node.levels).run(catalog.read(node.name), item, node.item_types, key, end)


def handlers(catalog: Catalog, chosen: list[Node]) -> dict[str, service.Handler]:
    """Queries by name; each gets the catalog, and by it every table, with the request's parameters."""
    return {n.name: service.Handler(lambda n=n, **given: n.load()(catalog, **given), n.parameters, n.data_type) for n in chosen}


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tramlake", description="Collects, derives, compacts and answers as a configuration has it.")
    parser.add_argument("configuration", help="folder of TOML files")
    parser.add_argument("catalog", help="folder of the snapshot tables")
    for verb in ("collect", "derive", "compact", "serve"):
        parser.add_argument(f"--{verb}", nargs="*", default=[], metavar="NAME", help=f"what to {verb}; all for everything")
    parser.add_argument("--archive", help="folder of compacted file sets (by default beside the catalog)")
    parser.add_argument("--once", action="store_true", help="do everything once, sources first, and end")
    parser.add_argument("--host", default="localhost")
    parser.add_argument("--port", type=int, default=8888)
    parser.add_argument("--allowed", nargs="*", help="addresses that may ask; all by default")
    parser.add_argument("--log-level", default="INFO")
    return parser.parse_args(given)


def main(given: list[str] | None = None, spark: SparkSession | None = None, stop: threading.Event | None = None, now: Callable[[], datetime] = datetime.now) -> list[threading.Thread]:
    """Starts what the arguments ask for; with --once it is done when this returns, else the threads are returned, which end when `stop` is set."""
    args = arguments(given)
    logging.basicConfig(level=args.log_level)
    if args.once and args.serve:
        raise ValueError("a service does not end: --serve and --once exclude each other")
    every = nodes.load(args.configuration)
    chosen = {verb: nodes.selected(every, kind, getattr(args, verb)) for verb, kind in KINDS.items()}
    compacted = [n for n in every.values() if n.levels and (n.name in args.compact or args.compact in (["all"], ["*"]))]
    catalog = Catalog(spark or SparkSession.builder.getOrCreate(), args.catalog)
    catalog.create(n.name for n in every.values() if n.kind != "handlers")
    archive = args.archive or f"{args.catalog.rstrip('/')}-archive"
    if args.once:
        for node in chosen["collect"]:
            runner.collect(catalog, node, now())
        for name in nodes.order(every):
            if every[name] in chosen["derive"]:
                runner.derive_all(catalog, every[name])
        for node in compacted:
            compact(catalog, node, archive, now())
        return []
    stop = stop or threading.Event()
    tasks = [(lambda n=n: on_schedule(lambda: runner.collect(catalog, n, now()), n.schedule, stop, now)) for n in chosen["collect"]]
    tasks += [(lambda n=n: runner.loop(lambda: runner.derive(catalog, n), stop.is_set, stop.wait)) for n in chosen["derive"]]
    tasks += [(lambda n=n: runner.loop(lambda: bool(compact(catalog, n, archive, now())), stop.is_set, stop.wait, runner.COMPACTION)) for n in compacted]
    if chosen["serve"]:
        server = service.serve(handlers(catalog, chosen["serve"]), args.host, args.port, args.allowed)
        tasks += [server.serve_forever, lambda: (stop.wait(), server.shutdown())]
    threads = [threading.Thread(target=t, daemon=True) for t in tasks]
    for t in threads:
        t.start()
    return threads
