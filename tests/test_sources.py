import io
import json
import struct
import threading
import zipfile
from datetime import datetime
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from tramlake.sources import archives, collectors, feeds, geojson, http
from tramlake.sources.blobs import Blobs


def paged(total=25, with_total=True):
    """A transport that answers pages of numbers; keeps what it was asked."""
    asked = []

    def transport(url, params, headers):
        asked.append((params, headers))
        rows = [{"n": k} for k in range(params["offset"], min(total, params["offset"] + params["limit"]))]
        return 200, json.dumps({"results": rows} | ({"total_count": total} if with_total else {})).encode()

    return transport, asked


@pytest.mark.parametrize("with_total", [True, False])
def test_offset_pages(spark, with_total):
    transport, _ = paged(25, with_total)
    http.register(spark, transport, "paged")
    df = spark.read.format("paged").option("url", "u").option("pagination", "offset").option("page_size", 10).load()
    assert sorted(json.loads(r.value)["n"] for r in df.collect()) == [*range(25)]
    assert df.rdd.getNumPartitions() == (3 if with_total else 1)


def test_pages_end_where_they_should():
    get = lambda transport: lambda params: json.loads(transport("u", params, {})[1])
    transport, asked = paged(20, False)
    assert [len(p) for p in http.pages_by_offset(get(transport), 10)] == [10, 10, 0] and len(asked) == 3
    transport, asked = paged(20)
    assert [len(p) for p in http.pages_by_offset(get(transport), 10)] == [10, 10] and len(asked) == 2
    with pytest.raises(ValueError):
        [*http.pages_by_offset(get(paged(5, False)[0]), 10, strict=True)]
    numbered = lambda params: {"_embedded": {"response": [params["page"]]}, "page": {"totalPages": 3}}
    assert [*http.pages_by_number(numbered, 5, "_embedded.response", "page.totalPages")] == [[0], [1], [2]]


def test_nested_member_and_box(spark):
    asked = []

    def transport(url, params, headers):
        asked.append(params)
        return 200, json.dumps({"data": {"bikes": [{"lat": 1.0}, {"lat": 2.0}], "box": params}}).encode()

    http.register(spark, transport, "nested")
    rows = spark.read.format("nested").option("url", "u").option("results", "data.bikes").option("lamin", "49").load()
    assert [json.loads(r.value) for r in rows.collect()] == [{"lat": 1.0}, {"lat": 2.0}]


def test_tokens_and_failover():
    assert http.tokens("K", {"K": "a", "K_1": "b", "K_2": "c", "K_4": "e"}) == ["a", "b", "c"] and http.tokens("K", {}) == []
    good = lambda url, params, headers: (200, b"ok") if headers["Authorization"] == "b" else (401, b"")
    assert all(http.fetch_with_any(good, "u", ["a", "b", "c"], seed=s) == b"ok" for s in range(5))
    with pytest.raises(ValueError):
        http.fetch_with_any(good, "u", ["a", "c"])
    with pytest.raises(ValueError):
        http.fetch(lambda *_: (503, b""), "u")
    assert http.client_token(lambda url, params, headers, form: (200, json.dumps({"access_token": form["client_id"] + "!" * (not params)}).encode()), "u", "me", "s") == "me!"
    asked = []
    named = lambda url, params, headers: asked.append((params, headers)) or (200, b"ok")
    assert http.body({"url": "u", "token_key": "K", "token_parameter": "appid", "lamin": "4"}, named, {"q": 1}, {"K": "a"}) == b"ok" and asked == [({"q": 1, "lamin": "4", "appid": "a"}, {})]


def test_a_form_is_posted():
    class Answers(BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps({"access_token": f"{self.path} {body.decode()} {self.headers['Content-Type']}"}).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        got = http.client_token(http.urllib_transport, f"http://127.0.0.1:{server.server_port}/token", "me", "s&t")
    finally:
        server.shutdown()
    assert got == "/token grant_type=client_credentials&client_id=me&client_secret=s%26t application/x-www-form-urlencoded"


def test_binary_bodies_and_client_credentials(spark):
    def transport(url, params, headers, form=None):
        if url == "token":
            return 200, json.dumps({"access_token": f"{form['client_id']}-{form['client_secret']}"}).encode()
        return (200, b"\x00zip") if headers.get("Authorization") == "Bearer id-s" else (401, b"")

    http.register(spark, transport, "binary", {"ME": "id", "SECRET": "s"})
    read = spark.read.format("binary").option("url", "u").option("body", "binary")
    assert bytes(read.option("token_url", "token").option("client_key", "ME").option("secret_key", "SECRET").load().first().content) == b"\x00zip"


def test_bounds_reach_the_request(spark, tmp_path):
    def transport(url, params, headers):
        (tmp_path / "asked").write_text(json.dumps(params))
        return 200, json.dumps({"states": [["a", None, None, None, None, 4.0, 50.0], ["b", None, None, None, None, 4.0, 60.0]]}).encode()

    http.register_states(spark, transport, "states")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    df = spark.read.format("states").option("url", "u").option("lamin", "48").load().where("latitude >= 49.5 AND latitude <= 51.5 AND longitude >= 2.5")
    assert [json.loads(r.state)[0] for r in df.collect()] == ["a"]
    assert json.loads((tmp_path / "asked").read_text()) == {"lamin": "49.5", "lamax": "51.5", "lomin": "2.5"}


def test_feeds_by_their_options():
    from pathlib import Path

    from tramlake.plans import nodes
    from tramlake.streaming import runner

    found = nodes.load(str(Path(feeds.__file__).parents[2] / "feeds"))
    assert len(found) == 13 and all(n.load() and next(runner.due_times(n.schedule, datetime(2024, 1, 1))) for n in found.values())
    asked = []

    def transport(url, params, headers, form=None):
        asked.append((url, params, headers))
        if form:
            return 200, json.dumps({"access_token": form["client_secret"]}).encode()
        rows = [{"n": k} for k in range(7)]
        at, size = params.get("offset", params.get("page", 0) * params.get("size", 0)), params.get("limit", params.get("size", 9))
        return 200, json.dumps({"total_count": 7, "results": rows[at : at + size], "_embedded": {"response": rows[at : at + size]}, "page": {"totalPages": -(-7 // size)}}).encode()

    secrets = {"OPENSKY_CLIENT_ID": "i", "OPENSKY_CLIENT_SECRET": "s", "OPENWEATHER_API_KEY": "w"}
    got = {name: json.loads(n.load()(transport=transport, environment=secrets)) for name, n in found.items()}
    assert [r["n"] for r in got["city_incidents"]] == [r["n"] for r in got["city_bike_stations"]] == [*range(7)] and got["micromobility_bolt_zones"]["total_count"] == 7
    by = {u.rpartition("/")[2]: (p, h) for u, p, h in asked}
    assert by["weather"][0]["appid"] == "w" and by["all"] == ({"lamin": "49", "lomin": "2", "lamax": "52", "lomax": "7"}, {"Authorization": "Bearer s"})
    assert collectors.fetched("u", body="binary", transport=lambda *_: (200, b"\x00")) == b"\x00"


def test_blobs(spark, tmp_path):
    from datetime import datetime

    blobs = Blobs(spark, str(tmp_path))
    path = blobs.put("c", datetime(2024, 1, 2, 3, 4, 5), "tëxt")
    assert path.endswith("c/2024-01-02_03-04-05") and blobs.get(path) == "tëxt".encode()
    blobs.put("c", datetime(2024, 1, 2, 3, 4, 5), b"\x00\xff")
    assert blobs.get(path) == b"\x00\xff" and blobs.get(blobs.put("c", datetime(2024, 1, 3), None)) == b"" and blobs.read(f"{tmp_path}/c").count() == 1
    assert blobs.delete(path) and not blobs.delete(path)


def one(spark, value):
    return spark.createDataFrame([(json.dumps(value),)], "data string")


def test_aircraft(spark):
    full = ["abc", " XY1 ", "BE", 1, 2, 4.5, 50.5, 10.0, False, 1.0, 2.0, 3.0, None, 11.0, "7000", True, 2, 8]
    rows = one(spark, {"states": [full, full[:5] + [None] + full[6:], full[:17], full[:5] + [9.9, 50.0] + full[7:]]})
    got = feeds.aircraft(rows, (2.0, 49.0, 7.0, 52.0)).collect()
    assert [(r.callsign, r.position_source, r.category, r.geometry.x, r.spi) for r in got] == [("XY1", "MLAT", "Rotorcraft", 4.5, True), ("XY1", "MLAT", None, 4.5, True)]
    assert feeds.aircraft(rows).count() == 3 and feeds.aircraft(one(spark, {"states": None})).count() == 0


def test_vehicle_distances(spark):
    entry = [{"directionId": "8", "distanceFromPoint": 5, "pointId": "9"}]
    got = feeds.vehicle_distances(one(spark, [{"lineid": "1", "vehiclepositions": json.dumps(entry)}, {"lineid": "2", "vehiclepositions": entry + entry}]))
    assert sorted((r.lineId, r.pointId, r.distanceFromPoint) for r in got.collect()) == [("1", "9", 5), ("2", "9", 5), ("2", "9", 5)]


def test_other_feeds(spark):
    bikes = feeds.shared_vehicles(one(spark, {"data": {"bikes": [{"lat": 50.0, "lon": 4.0, "pricing": {"unit": "min"}}]}}), "lat:double,lon:double,pricing:struct<unit:string>")
    assert bikes.columns == ["pricing.unit", "geometry"] and bikes.first().geometry.x == 4.0
    names = ["number", "name_fr", "name_nl", "address_fr", "address_nl", "mu_fr", "mu_nl", "available_bikes", "available_bike_stands", "bike_stands", "last_update"]
    schema = "geo_point_2d struct<lon:double,lat:double>, " + ", ".join(f"{n} string" for n in names)
    villes = feeds.bike_stations(spark.createDataFrame([((4.0, 50.0), *names), (None, *names)], schema))
    assert villes.count() == 1 and villes.first().municipality_nl == "mu_nl" and villes.first().geometry.y == 50.0
    found = feeds.incidents(spark.createDataFrame([(1, (((149000.0, 170800.0),))), (2, ((None, 1.0),))], "id int, location struct<coordinates:struct<x:double,y:double>>"))
    assert found.columns == ["id", "geometry"] and found.count() == 1 and abs(found.first().geometry.x - 4.352) < 0.01
    air = spark.read.json(spark.sparkContext.parallelize([json.dumps({"id": "1", "station": {"geometry": {"coordinates": [4.3, 50.8, None], "type": "Point"}, "type": "F", "properties": {"label": "s"}}, "parameters": {"service": {"id": "1", "label": "l"}, "phenomenon": {"label": "no2"}}, "extras": ["x"]})]))
    flat = feeds.air_quality(air)
    assert flat.first().geometry.x == 4.3 and set(flat.columns) == {"id", "parameters.phenomenon.label", "station.properties.label", "geometry"}
    assert json.loads(str(feeds.zones(one(spark, {"data": {"geofencing_zones": {"a": 1}}})).first()[0].toJson())) == {"a": 1}


def test_geojson_round_trip(spark):
    rows = spark.createDataFrame([(1, "a", (4.0, 50.0)), (1, None, (4.5, 50.5)), (2, "c", (5.0, 51.0))], "t int, name string, geometry struct<x:double,y:double>")
    packed = geojson.collections(rows, ["t"], "name")
    assert json.loads(packed.where("t = 2").first().data) == {"type": "FeatureCollection", "features": [{"id": "c", "type": "Feature", "properties": {"name": "c"}, "geometry": {"type": "Point", "coordinates": [5.0, 51.0]}}]}
    assert sorted(map(str, geojson.features(packed, "name string").collect())) == sorted(map(str, rows.collect()))
    line = spark.createDataFrame([("l", [(0.0, 1.0), (2.0, 3.0)])], "n string, geometry array<struct<x:double,y:double>>")
    assert json.loads(geojson.feature(line, kind="LineString").first().feature)["geometry"]["coordinates"] == [[0.0, 1.0], [2.0, 3.0]]


def test_flatten_and_drop(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('b', 2, 'c', named_struct('d', 3)) AS s")
    assert geojson.flattened(df).columns == ["a", "s.b", "s.c.d"] and geojson.flattened(df, 1).columns == ["a", "s.b", "s.c"]
    assert geojson.without(geojson.flattened(df), ["s.b"]).columns == ["a", "s.c.d"] and geojson.without(df, ["zz"], strict=False).columns == ["a", "s"]
    with pytest.raises(ValueError):
        geojson.without(df, ["zz"])
    assert feeds.chosen(df, ["s", "nope", "a"]).columns == ["s", "a"]


def varint(n):
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, value):
    return varint(number << 3 | 2) + varint(len(value)) + value if isinstance(value, bytes) else varint(number << 3) + varint(value)


def test_live_updates(spark):
    stop = lambda sid, time, delay: field(2, field(4, sid) + field(2, field(1, delay) + (field(2, time) if time else b"")))
    trip = lambda name: field(1, field(1, name) + field(2, b"08:00:00") + field(3, b"20240102"))
    entity = lambda update: field(2, field(1, b"id") + field(3, update))
    message = field(1, field(1, b"2.0")) + entity(trip(b"t1") + stop(b"a", 0, 9) + stop(b"b", 1704180000, -60)) + entity(trip(b"t2") + stop(b"a", 0, 5)) + field(2, field(1, b"alert"))
    files = spark.createDataFrame([("f", bytearray(message)), ("g", None)], "name string, content binary")
    assert [tuple(r) for r in archives.live_updates(files).collect()] == [("f", "t1", "08:00:00", "20240102", "b", -60, 1704180000)]


def test_shapefile(spark):
    from tramlake.functions import geo

    at = spark.range(1).select(geo.to_lambert(geo.point(F.lit(4.35), F.lit(50.85))).alias("p")).first().p
    body = struct.pack("<I4d2I1i", 3, 0, 0, 0, 0, 1, 2, 0) + struct.pack("<4d", at.x, at.y, at.x + 100, at.y)
    records = struct.pack(">2I", 1, len(body) // 2) + body + struct.pack(">2I", 2, 2) + struct.pack("<I", 0)
    columns = [("LineCode", 6), ("Variante", 2), ("ColorHex", 8)]
    head = struct.pack("<B3xIHH20x", 3, 2, 32 + 32 * len(columns) + 1, 1 + sum(w for _, w in columns))
    head += b"".join(n.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([w]) + b"\0" * 15 for n, w in columns) + b"\r"
    rows = b"".join(b" " + b"".join(v.ljust(w).encode() for v, (_, w) in zip(r, columns, strict=True)) for r in (("071b", "1", "#FFF"), ("1", "2", "#000")))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("x/ACT_LINES.shp", b"\0" * 100 + records)
        z.writestr("x/ACT_LINES.dbf", head + rows)
        z.writestr("x/ACT_STOPS.shp", b"")
    got = archives.line_shapes(spark.createDataFrame([(bytearray(data.getvalue()),)], "content binary")).collect()
    assert len(got) == 1 and (got[0].ligne, got[0].variante, got[0].color_hex) == ("071b", 1, "#FFF")
    assert abs(got[0].geometry[0].x - 4.35) < 1e-6 and abs(got[0].geometry[0].y - 50.85) < 1e-6
