"""Collecting an open-data feed as a node's options describe it, without code of its own."""

from __future__ import annotations

import json

from tramlake.sources import http


def fetched(
    url: str, params: dict | None = None, body: str = "json", pagination: str = "none", page_size: int = 1000, results: str = "", total: str = "", transport: http.Transport = http.urllib_transport,
    environment: dict[str, str] | None = None, **access,
) -> str | bytes:
    """A feed's answer: the bytes of a `binary` one, else the JSON text of the member `results`, of all pages together where there are several
    (pagination: offset or page). `access` has the names of what secrets are kept under, as http.register() lists them, and a box."""
    options = {"url": url} | access
    get = lambda more: json.loads(http.body(options, transport, (params or {}) | more, environment))
    if body == "binary":
        return http.body(options, transport, params or {}, environment)
    if pagination == "offset":
        value = [row for page in http.pages_by_offset(get, page_size, results or "results", total or "total_count") for row in page]
    elif pagination == "page":
        value = [row for page in http.pages_by_number(get, page_size, results, total or "page.totalPages") for row in page]
    else:
        value = http.at(get({}), results)
    return json.dumps(value, ensure_ascii=False)
