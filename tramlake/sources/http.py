"""Paginated HTTP sources as Spark data sources.

A transport is a function (url, params, headers) -> (status, bytes), and of a fourth argument, form, where it is to post one. The
default one uses the standard library; tests and offline runs give their own through register().
"""

from __future__ import annotations

import json
import os
import random
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, GreaterThanOrEqual, InputPartition, LessThanOrEqual

BOX = ("lamin", "lomin", "lamax", "lomax")

Transport = Callable[..., tuple[int, bytes]]


def urllib_transport(url: str, params: dict, headers: dict, form: dict | None = None) -> tuple[int, bytes]:
    from urllib.error import HTTPError
    from urllib.parse import urlencode
    from urllib.request import Request, urlopen

    try:
        data = None if form is None else urlencode(form).encode()
        with urlopen(Request(f"{url}?{urlencode(params)}" if params else url, data, headers), timeout=60) as answer:
            return answer.status, answer.read()
    except HTTPError as error:
        return error.code, error.read()


def tokens(key: str, environment: dict[str, str] | None = None) -> list[str]:
    """The values of KEY, KEY_1, KEY_2, ... as far as they go on."""
    environment = os.environ if environment is None else environment
    out = [environment[key]] if key in environment else []
    k = 1
    while f"{key}_{k}" in environment:
        out.append(environment[f"{key}_{k}"])
        k += 1
    return out


def fetch(transport: Transport, url: str, params: dict | None = None, headers: dict | None = None, form: dict | None = None) -> bytes:
    status, body = transport(url, params or {}, headers or {}) if form is None else transport(url, params or {}, headers or {}, form)
    if status >= 400:
        raise ValueError(f"{url} answered {status}")
    return body


def fetch_with_any(transport: Transport, url: str, keys: list[str], params: dict | None = None, header: str = "Authorization", seed: int | None = None, parameter: str | None = None) -> bytes:
    """The first good answer over the tokens in random order, each given in a header, or in a query parameter where one is named."""
    for token in random.Random(seed).sample(keys, len(keys)):
        status, body = transport(url, params or {}, {header: token}) if parameter is None else transport(url, (params or {}) | {parameter: token}, {})
        if status < 400:
            return body
    raise ValueError(f"no token gives an answer from {url}")


def client_token(transport: Transport, url: str, client: str, secret: str) -> str:
    """An access token by client credentials, posted as a form: a secret in a URL would end up in logs."""
    return json.loads(fetch(transport, url, form={"grant_type": "client_credentials", "client_id": client, "client_secret": secret}))["access_token"]


def at(value, path: str):
    for name in path.split(".") if path else ():
        value = value[name]
    return value


def pages_by_offset(get: Callable[[dict], dict], size: int, results: str = "results", total: str | None = "total_count", strict: bool = False) -> Iterator[list]:
    """Lists of results; ends at the total count, or at a short page where there is none (a strict source must have one)."""
    offset = 0
    while True:
        page = get({"limit": size, "offset": offset})
        rows = at(page, results)
        yield rows
        count = page.get(total) if total else None
        if count is None and strict:
            raise ValueError(f"the answer has no {total}")
        offset += size
        if offset >= count if count is not None else len(rows) < size:
            return


def pages_by_number(get: Callable[[dict], dict], size: int, results: str, total: str) -> Iterator[list]:
    """Lists of results of pages 0, 1, ... up to the number of pages."""
    page = 0
    while True:
        answer = get({"page": page, "size": size})
        yield at(answer, results)
        page += 1
        if page >= at(answer, total):
            return


def body(options: dict, transport: Transport, params: dict, environment: dict[str, str] | None = None) -> bytes:
    """The answer to a request as the options have it: box parameters, tokens, client credentials. Secrets come from `environment`,
    by default the variables of the process that reads."""
    environment = os.environ if environment is None else environment
    params = params | {name: options[name] for name in BOX if name in options}
    if "token_key" in options:
        return fetch_with_any(transport, options["url"], tokens(options["token_key"], environment), params, options.get("token_header", "Authorization"), parameter=options.get("token_parameter"))
    headers = {}
    if "token_url" in options:
        token = client_token(transport, options["token_url"], environment[options["client_key"]], environment[options["secret_key"]])
        headers = {"Authorization": f"Bearer {token}"}
    return fetch(transport, options["url"], params, headers)


class Page(InputPartition):
    def __init__(self, params: dict):
        super().__init__(params)
        self.params = params


class Reader(DataSourceReader):
    """One row a result, its JSON text. With a total count, each page after the first is a partition of its own."""

    def __init__(self, options: dict, transport: Transport, environment: dict[str, str] | None = None):
        self.options, self.transport, self.environment = options, transport, environment
        self.size, self.style = int(options.get("page_size", 1000)), options.get("pagination", "none")
        self.results = options.get("results", "results")

    def _body(self, params: dict) -> bytes:
        return body(self.options, self.transport, params, self.environment)

    def _get(self, params: dict) -> dict:
        return json.loads(self._body(params))

    def partitions(self) -> list[InputPartition]:
        if self.style == "offset":
            total = self._get({"limit": 1, "offset": 0}).get(self.options.get("total", "total_count"))
            if total is not None:
                return [Page({"limit": self.size, "offset": k}) for k in range(0, max(1, total), self.size)]
        return [Page({})]

    def read(self, partition: Page) -> Iterator[tuple]:
        if self.options.get("body") == "binary":
            yield (self._body({}),)
            return
        if self.style == "none":
            body = self._get({})
            rows = at(body, self.results) if self.results else body
            pages = [rows if isinstance(rows, list) else [rows]]
        elif partition.params:
            pages = [at(self._get(partition.params), self.results)]
        elif self.style == "offset":
            pages = pages_by_offset(self._get, self.size, self.results, None)
        else:
            pages = pages_by_number(self._get, self.size, self.results, self.options.get("total", "page.totalPages"))
        for page in pages:
            for row in page:
                yield (json.dumps(row, ensure_ascii=False),)


def register(spark: SparkSession, transport: Transport = urllib_transport, name: str = "http_json", environment: dict[str, str] | None = None) -> None:
    """Makes spark.read.format(name) read JSON over HTTP. Options: url, pagination (none, offset, page), page_size, results, total,
    token_key (environment variables KEY, KEY_1, ...), token_header or token_parameter, token_url with client_key and secret_key (names of environment
    variables), lamin, lomin, lamax, lomax, body (binary: one row, column content)."""

    class HttpJson(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "content binary" if self.options.get("body") == "binary" else "value string"

        def reader(self, schema) -> Reader:
            return Reader(dict(self.options), transport, environment)

    spark.dataSource.register(HttpJson)


class StatesReader(DataSourceReader):
    """State vectors of aircraft; bounds on longitude and latitude become the request's box."""

    def __init__(self, options: dict, transport: Transport, environment: dict[str, str] | None = None):
        self.options, self.transport, self.environment = options, transport, environment

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        names = {("latitude", GreaterThanOrEqual): ("lamin", max), ("latitude", LessThanOrEqual): ("lamax", min), ("longitude", GreaterThanOrEqual): ("lomin", max), ("longitude", LessThanOrEqual): ("lomax", min)}
        for f in filters:
            if found := names.get((getattr(f, "attribute", ("",))[0], type(f))):
                name, tighter = found
                self.options[name] = str(tighter(float(self.options.get(name, f.value)), f.value))
            yield f  # the service may round the box, so the filter is kept

    def read(self, partition) -> Iterator[tuple]:
        rows = json.loads(body(self.options, self.transport, {}, self.environment)).get("states") or []
        for row in rows:
            yield (json.dumps(row), row[5], row[6])


def register_states(spark: SparkSession, transport: Transport = urllib_transport, name: str = "aircraft_states", environment: dict[str, str] | None = None) -> None:
    """Makes spark.read.format(name) read aircraft state vectors: state (JSON text), longitude, latitude. Filters reach the request
    with spark.sql.python.filterPushdown.enabled."""

    class States(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "state string, longitude double, latitude double"

        def reader(self, schema) -> StatesReader:
            return StatesReader(dict(self.options), transport, environment)

    spark.dataSource.register(States)
