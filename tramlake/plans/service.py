"""A thin HTTP service over query functions."""

from __future__ import annotations

import builtins
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qsl, urlsplit


@dataclass
class Handler:
    """A query function with the names and types of its parameters, and what its results are."""

    run: Callable
    parameters: dict[str, str] = field(default_factory=dict)
    data_type: str = "json"


def typed(given: dict[str, str], wanted: dict[str, str]) -> dict:
    """Parameters as the types asked for; others, and values that don't fit, raise ValueError."""
    if unknown := set(given) - set(wanted):
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    return {k: getattr(builtins, wanted[k])(v) for k, v in given.items()}


def answer(handlers: dict[str, Handler], url: str, client: str, allowed: list[str] | None = None) -> tuple[int, str, bytes]:
    """(status, content type, body) of a request; the query runs before the status is given."""
    if allowed is not None and client not in allowed:
        return 403, "text/plain", b"forbidden"
    parts = urlsplit(url)
    handler = handlers.get(parts.path.strip("/"))
    if handler is None:
        return 404, "text/plain", b"no such query"
    try:
        arguments = typed(dict(parse_qsl(parts.query)), handler.parameters)
    except ValueError as error:
        return 400, "text/plain", str(error).encode()
    value = handler.run(**arguments)
    if value is None:
        return 404, "text/plain", b"no data"
    if handler.data_type == "json":
        return 200, "application/json", (value if isinstance(value, str) else json.dumps(value)).encode()
    return 200, "text/plain" if handler.data_type == "text" else "application/octet-stream", value.encode() if isinstance(value, str) else bytes(value)


def serve(handlers: dict[str, Handler], host: str = "localhost", port: int = 8888, allowed: list[str] | None = None) -> ThreadingHTTPServer:
    """A server with a thread a request; the caller runs serve_forever()."""

    class Requests(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            status, kind, body = answer(handlers, self.path, self.client_address[0], allowed)
            self.send_response(status)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

    return ThreadingHTTPServer((host, port), Requests)
