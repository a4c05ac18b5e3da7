import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracell.operators import raster
from terracell.schema import CELLS, Grid
from terracell.sources import cells, geotiff, vector
from terracell.streaming.tiles import open_tiles, process_new_tiles


def test_geojson_wkt_and_csv(spark, tmp_path):
    features = [
        {"properties": {"id": "a", "height": 3.5}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 0]]]}},
        {"properties": {"id": "b"}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}},
        {"properties": {"id": "c"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
        {"properties": {"id": "d"}, "geometry": {"type": "Point", "coordinates": [7, 8]}},
    ]
    (tmp_path / "l.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("height", T.DoubleType())])
    df = vector.read_geojson(spark, str(tmp_path / "l.geojson"), schema)
    got = {r.id: r for r in df.collect()}
    assert got["a"].height == 3.5 and got["b"].height is None
    assert [len(r) for r in got["c"].rings] == [4, 4] and got["d"].rings[0][0].x == 7.0
    ring = vector.open_ring(F.col("rings")[0])
    back = df.filter("id = 'a'").select(ring.alias("r"), vector.from_wkt(vector.to_wkt(ring)).alias("b")).first()
    assert back.r == back.b and len(back.r) == 3
    vector.write_table(df, str(tmp_path / "t.csv"))
    assert vector.read_table(spark, str(tmp_path / "t.csv"), T.StructType([*schema, T.StructField("geometry_type", T.StringType())])).count() == 4


def test_polygons_with_holes_and_parts(spark, tmp_path):
    text = "MULTIPOLYGON (((0 0, 10 0, 10 10, 0 10, 0 0), (2 2, 8 2, 8 8, 2 8, 2 2)), ((20 0, 24 0, 24 4, 20 4, 20 0)))"
    rows = [("m", text), ("p", "polygon z ((0 0 1, 3 0 1, 3 3 1, 0 0 1))"), ("l", "LINESTRING (0 0, 1 1)"), ("n", None), ("e", "POLYGON EMPTY")]
    df = spark.createDataFrame(rows, "id string, w string").withColumn("polygons", vector.wkt_polygons(F.col("w")))
    got = {r.id: r.polygons for r in df.collect()}
    assert [[len(ring) for ring in p] for p in got["m"]] == [[4, 4], [4]] and [len(r) for r in got["p"][0]] == [3] and got["l"] is got["n"] is got["e"] is None
    assert df.filter("id = 'm'").select(vector.wkt_polygons(vector.to_wkt_multi(F.col("polygons"))).alias("p")).first().p == got["m"]
    rings = df.withColumn("rings", F.flatten("polygons"))
    cells = {(r.id, r.row, r.col) for r in raster.covered(rings.select("id", "rings"), 0.0, 30.0, 1.0, 30, 30, ring="rings").collect()}
    assert sum(c[0] == "m" for c in cells) == 100 - 36 + 16 and ("m", 25, 5) not in cells and ("m", 29, 22) in cells
    lines = [json.dumps({"type": "Feature", "properties": {"id": k}, "geometry": {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 0], [1, 0], [1, 2]], [[5, 5]]]}}) for k in "ab"]
    (tmp_path / "l.ndjson").write_text("\n".join(lines))
    layer = vector.read_geojson(spark, str(tmp_path / "l.ndjson"), T.StructType([T.StructField("id", T.StringType())]), lines=True)
    found = sorted((r.id, r.line, r.place, r.x1, r.y1, r.x2, r.y2) for r in vector.segments(layer).collect())
    assert found == [(k, 0, n, *s) for k in "ab" for n, s in ((0, (0.0, 0.0, 1.0, 0.0)), (2, (1.0, 0.0, 1.0, 2.0)))]


def test_cells(spark, tmp_path):
    df = spark.range(64).select((F.col("id") / 8).cast("int").alias("row"), (F.col("id") % 8).cast("int").alias("col"), F.col("id").cast("double").alias("v"))
    path = str(tmp_path / "c")
    cells.write_cells(df, path, tile=4)
    assert cells.read_cells(spark, path, (2, 5, 3, 6), tile=4).count() == 9
    cells.write_cells(df.filter("row < 4 and col < 4").withColumn("v", F.lit(-5.0)), path, tile=4)
    assert cells.read_cells(spark, path).count() == 64 and cells.read_cells(spark, path).filter("v = -5").count() == 16
    assert len(cells.read_many(spark, str(tmp_path / "c*"))) == 1
    with pytest.raises(FileNotFoundError):
        cells.read_many(spark, str(tmp_path / "none*"))
    tif = tmp_path / "o.tif"
    for compress in (True, False):
        geotiff.to_geotiff(df.filter("row <> 1").withColumn("w", -F.col("v")), str(tif), Grid(100, 40, 5, 8, 8), ["v", "w"], compress=compress, nodata=-99)
        assert geotiff.geotiff_grids(spark, str(tif))[0][1:] == (Grid(100, 40, 5, 8, 8), 2, -99.0) and b"role=\"description\">w<" in tif.read_bytes()
        got = {(r.row, r.col): (r.b1, r.b2) for r in geotiff.read_geotiff(spark, str(tmp_path / "*.tif")).collect()}
        assert len(got) == 64 and got[1, 0] == (None, None) and got[7, 7] == (63.0, -63.0) and got[0, 3] == (3.0, -3.0)
    assert raw_floats(tif)[16] == -99 and raw_floats(tif)[126:] == (63, -63)


def raw_floats(tif):
    return struct.unpack("<128f", tif.read_bytes()[-512:])


def lzw(data):
    """TIFF's LZW, the plain way."""
    out, bits, table, width, before = 0, 0, {}, 9, b""
    codes = []

    def put(code):
        codes.append((code, width))

    put(256)
    table, size = {bytes([k]): k for k in range(256)}, 258
    for k in data:
        if before + bytes([k]) in table:
            before += bytes([k])
            continue
        put(table[before])
        table[before + bytes([k])] = size
        size += 1
        before = bytes([k])
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
        if size == 4094:
            put(256)
            table, size, width = {bytes([k]): k for k in range(256)}, 258, 9
    put(table[before])
    size += 1
    width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
    put(257)
    for code, w in codes:
        out, bits = out << w | code, bits + w
    pad = -bits % 8
    return (out << pad).to_bytes((bits + pad) // 8, "big")


@pytest.mark.parametrize("tiled,compression,predictor,apart,order", [(True, 5, 2, False, "<"), (False, 5, 1, True, ">"), (True, 8, 1, True, "<"), (False, 32773, 2, False, "<"), (False, 1, 1, False, ">")])
def test_geotiff_layouts(spark, tmp_path, tiled, compression, predictor, apart, order):
    nrow, ncol, bands = 37, 45, 2
    want = np.random.default_rng(compression).integers(-5, 300, (nrow, ncol, bands)).astype(f"{order}i2")
    block = (16, 32) if tiled else (10, ncol)
    planes = [want[:, :, b : b + 1] for b in range(bands)] if apart else [want]
    pieces = []
    for plane in planes:
        for r in range(0, nrow, block[0]):
            for c in range(0, ncol, block[1]):
                part = plane[r : r + block[0], c : c + block[1]]
                if tiled:
                    part = np.pad(part, ((0, block[0] - part.shape[0]), (0, block[1] - part.shape[1]), (0, 0)))
                if predictor == 2:
                    part = np.concatenate([part[:, :1], np.diff(part, axis=1)], axis=1)
                raw = np.ascontiguousarray(part, f"{order}i2").tobytes()
                pieces.append({1: lambda x: x, 5: lzw, 8: zlib.compress, 32773: lambda x: b"".join(bytes([len(x[k : k + 100]) - 1]) + x[k : k + 100] for k in range(0, len(x), 100))}[compression](raw))
    tags = [(256, "H", [ncol]), (257, "H", [nrow]), (258, "H", [16] * bands), (259, "H", [compression]), (277, "H", [bands]), (284, "H", [2 if apart else 1]), (317, "H", [predictor]), (339, "H", [2] * bands), (33550, "d", [10.0, 10.0, 0.0]), (33922, "d", [0.0, 0.0, 0.0, 500.0, 900.0, 0.0]), (42113, "s", [b"-5\0\0\0"])]
    tags += [(322, "H", [block[1]]), (323, "H", [block[0]]), (324, "I", None), (325, "I", [len(p) for p in pieces])] if tiled else [(278, "H", [block[0]]), (273, "I", None), (279, "I", [len(p) for p in pieces])]
    body = 8 + 2 + 12 * len(tags) + 4
    extra, entries, data_at = b"", b"", body + 4000
    starts = [data_at + sum(map(len, pieces[:k])) for k in range(len(pieces))]
    for tag, form, value in sorted(tags):
        value = starts if value is None else value
        packed = value[0] if form == "s" else struct.pack(f"{order}{len(value)}{form}", *value)
        count = len(packed) if form == "s" else len(value)
        kind = {"H": 3, "I": 4, "d": 12, "s": 2}[form]
        if len(packed) <= 4:
            entries += struct.pack(f"{order}HHI", tag, kind, count) + packed.ljust(4, b"\0")
        else:
            entries += struct.pack(f"{order}HHII", tag, kind, count, body + len(extra))
            extra += packed + b"\0" * (len(packed) % 2)
    head = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HIH", 42, 8, len(tags))
    (tmp_path / "a.tif").write_bytes((head + entries + b"\0" * 4 + extra).ljust(data_at, b"\0") + b"".join(pieces))
    got = {(r.row, r.col): (r.b1, r.b2) for r in geotiff.read_geotiff(spark, str(tmp_path / "a.tif")).collect()}
    assert geotiff.geotiff_grids(spark, str(tmp_path / "a.tif"))[0][1] == Grid(500.0, 900.0, 10.0, nrow, ncol, 0)
    assert got == {(r, c): tuple(None if v == -5 else float(v) for v in want[r, c]) for r in range(nrow) for c in range(ncol)}
    shifted = geotiff.on_grid(geotiff.read_geotiff(spark, str(tmp_path / "a.tif"), [2]), Grid(500.0, 900.0, 10.0, nrow, ncol), Grid(520.0, 890.0, 10.0, 5, 5))
    assert {(r.row, r.col): r.b2 for r in shifted.collect()} == {(r, c): got[r + 1, c + 2][1] for r in range(5) for c in range(5)}
    with pytest.raises(ValueError):
        geotiff.on_grid(shifted, Grid(0, 0, 10, 5, 5), Grid(3, 0, 10, 5, 5))


def test_stream_keeps_cells_of_a_tile_that_comes_in_two_batches(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("s", "o", "k"))
    for batch in ([(0, 0, 1.0), (0, 1, 5.0), (40, 0, 7.0)], [(0, 1, 2.0), (0, 2, 3.0)], [(1, 1, 4.0)]):
        spark.createDataFrame(batch, "row int, col int, v double").write.mode("append").parquet(src)
        process_new_tiles(spark, src, CELLS, out, check, lambda df: df, tile=16)
    got = spark.read.parquet(out)
    assert sorted((r.row, r.col, r.v) for r in got.collect()) == [(0, 0, 1.0), (0, 1, 2.0), (0, 2, 3.0), (1, 1, 4.0), (40, 0, 7.0)]
    assert sorted((r.tile_r, r.tile_c) for r in got.select("tile_r", "tile_c").distinct().collect()) == [(0, 0), (2, 0)]


def test_stream_takes_new_tiles_once(spark, tmp_path):
    df = spark.createDataFrame([(0, 0, 1.0), (600, 3, 2.0)], "row int, col int, v double")
    calls = []

    def operate(batch):
        calls.append(1)
        return batch.withColumn("v", F.col("v") * 10)

    src, out, check = (str(tmp_path / n) for n in ("s", "o", "k"))
    df.write.parquet(src)
    for _ in range(2):
        process_new_tiles(spark, src, CELLS, out, check, operate)
    assert len(calls) == 1 and sorted(r.v for r in spark.read.parquet(out).collect()) == [10.0, 20.0]
    tiles = spark.createDataFrame([(0, 0), (0, 1)], "ti int, tj int")
    assert open_tiles(tiles, tiles.limit(1)).count() == 1
