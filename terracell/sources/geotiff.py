"""GeoTIFF files as cell tables, and back.

The reader decodes strips and tiles one by one in the tasks, so a task holds
one file's bytes and one block's cells; files come through Spark's binary
source, so any store that Spark reads will do. Baseline layouts are known:
both byte orders, strips and tiles, no compression, LZW, Deflate and
PackBits, horizontal differencing, integers and floats, bands interleaved or
apart. Anything else raises ValueError.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracell.schema import Grid

#: Bytes of a value by TIFF type, and its format.
_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
_KINDS = {1: "u", 2: "i", 3: "f"}


def _lzw(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits from the high end, 256 clears the table, 257 ends."""
    out, table, width, before = [], [], 9, b""
    held, bits = 0, 0
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, before = [bytes([k]) for k in range(256)] + [b"", b""], 9, b""
            continue
        piece = table[code] if code < len(table) else before + before[:1]
        if before:
            table.append(before + piece[:1])
        out.append(piece)
        before = piece
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


def _packbits(data: bytes) -> bytes:
    out, at = [], 0
    while at < len(data):
        n = data[at] if data[at] < 128 else data[at] - 256
        if n >= 0:
            out.append(data[at + 1 : at + 2 + n])
            at += 2 + n
        else:
            out.append(data[at + 1 : at + 2] * (1 - n if n != -128 else 0))
            at += 2
    return b"".join(out)


_DECODE = {1: bytes, 5: _lzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: _packbits}


@dataclass
class Header:
    """What a file says about itself: its grid, the type of its values and where its blocks lie."""

    grid: Grid
    bands: int
    nodata: float | None
    dtype: np.dtype
    compression: int
    predictor: int
    apart: bool
    block: tuple[int, int]
    offsets: tuple[int, ...]
    counts: tuple[int, ...]

    @classmethod
    def of(cls, raw: bytes) -> Header:
        order = {b"II": "<", b"MM": ">"}.get(raw[:2])
        if order is None or struct.unpack_from(order + "H", raw, 2)[0] not in (42, 43):
            raise ValueError("not a TIFF file")
        big = struct.unpack_from(order + "H", raw, 2)[0] == 43
        at = struct.unpack_from(order + ("Q" if big else "I"), raw, 8 if big else 4)[0]
        count, entry, inline = (struct.unpack_from(order + "Q", raw, at)[0], 20, 8) if big else (struct.unpack_from(order + "H", raw, at)[0], 12, 4)
        tags: dict[int, tuple] = {}
        for k in range(count):
            place = at + (8 if big else 2) + k * entry
            tag, kind = struct.unpack_from(order + "HH", raw, place)
            if kind not in _TYPES:
                continue
            n = struct.unpack_from(order + ("Q" if big else "I"), raw, place + 4)[0]
            form = f"{order}{n}{_TYPES[kind]}"
            value = place + entry - inline
            if struct.calcsize(form) > inline:
                value = struct.unpack_from(order + ("Q" if big else "I"), raw, value)[0]
            tags[tag] = struct.unpack_from(form, raw, value)

        def one(tag: int, default: int) -> int:
            return tags.get(tag, (default,))[0]

        width, height = one(256, 0), one(257, 0)
        if 34264 in tags:
            raise ValueError("a turned raster (model transformation) is not supported")
        bits, kind = set(tags.get(258, (1,))), set(tags.get(339, (1,)))
        if len(bits) > 1 or len(kind) > 1 or not bits <= {8, 16, 32, 64} or not kind <= set(_KINDS):
            raise ValueError("bands must have one type of 8, 16, 32 or 64 bits")
        if one(259, 1) not in _DECODE or one(317, 1) not in (1, 2):
            raise ValueError("unknown compression or predictor")
        res, north_res = tags.get(33550, (1.0, 1.0))[:2]
        if abs(res - north_res) > 1e-9 * abs(res):
            raise ValueError("cells must be square")
        tie = tags.get(33922, (0.0, 0.0, 0.0, 0.0, 0.0, 0.0))
        keys = tags.get(34735, ())
        epsg = next((keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k] in (2048, 3072)), 0)
        text = tags.get(42113, (b"",))[0].rstrip(b"\0 ")
        tiled = 322 in tags
        return cls(
            Grid(tie[3] - tie[0] * res, tie[4] + tie[1] * res, res, height, width, epsg),
            one(277, 1),
            float(text) if text else None,
            np.dtype(f"{order}{_KINDS[kind.pop()]}{bits.pop() // 8}"),
            one(259, 1),
            one(317, 1),
            one(284, 1) == 2,
            (one(323, 0), one(322, 0)) if tiled else (min(one(278, height), height), width),
            tags[324 if tiled else 273],
            tags[325 if tiled else 279],
        )

    def blocks(self, raw: bytes) -> Iterator[tuple[int, int, list[np.ndarray]]]:
        """(first row, first column, values of each band) block by block, from the file's bytes."""
        down, across = -(-self.grid.nrow // self.block[0]), -(-self.grid.ncol // self.block[1])
        depth = 1 if self.apart else self.bands
        for k in range(down * across):
            r0, c0 = k // across * self.block[0], k % across * self.block[1]
            rows, cols = min(self.block[0], self.grid.nrow - r0), min(self.block[1], self.grid.ncol - c0)
            bands = []
            for plane in range(self.bands if self.apart else 1):
                n = k + plane * down * across
                data = _DECODE[self.compression](raw[self.offsets[n] : self.offsets[n] + self.counts[n]])
                values = np.frombuffer(data[: len(data) // (self.dtype.itemsize * self.block[1] * depth) * (self.dtype.itemsize * self.block[1] * depth)], self.dtype).reshape(-1, self.block[1], depth)
                if self.predictor == 2:
                    values = np.cumsum(values, axis=1, dtype=self.dtype)
                bands += [values[:rows, :cols, b] for b in range(depth)]
            yield r0, c0, bands


def read_geotiff(spark: SparkSession, path: str, bands: list[int] | None = None) -> DataFrame:
    """(path, row, col, b1, b2, ...) of every cell of the files that the path or glob matches; nodata and nan are null.

    ``bands`` (from 1) names those that are read; all files must have them.
    Without it the first file's bands are read.
    """
    wanted = bands or list(range(1, geotiff_grids(spark, path)[0][2] + 1))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                raw = batch.column(1)[k].as_buffer().to_pybytes()
                header = Header.of(raw)
                for r0, c0, values in header.blocks(raw):
                    rows, cols = np.mgrid[r0 : r0 + values[0].shape[0], c0 : c0 + values[0].shape[1]]
                    columns = [pa.repeat(batch.column(0)[k], rows.size), pa.array(rows.ravel(), pa.int32()), pa.array(cols.ravel(), pa.int32())]
                    for b in wanted:
                        v = values[b - 1].ravel().astype(float)
                        columns.append(pa.array(v, mask=np.isnan(v) if header.nodata is None else np.isnan(v) | (v == header.nodata)))
                    yield pa.RecordBatch.from_arrays(columns, names=["path", "row", "col", *(f"b{b}" for b in wanted)])

    return _files(spark, path).mapInArrow(cells, "path string, row int, col int, " + ", ".join(f"b{b} double" for b in wanted))


def geotiff_grids(spark: SparkSession, path: str) -> list[tuple[str, Grid, int, float | None]]:
    """(path, grid, number of bands, nodata) of each file, by path: one small row a file."""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Header.of(x.as_buffer().to_pybytes()) for x in batch.column(1)]
            grids = [[g.grid.west, g.grid.north, g.grid.res, float(g.grid.nrow), float(g.grid.ncol), float(g.grid.epsg)] for g in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grids, pa.list_(pa.float64())), pa.array([g.bands for g in found], pa.int32()), pa.array([g.nodata for g in found], pa.float64())], names=["path", "grid", "bands", "nodata"])

    rows = _files(spark, path).mapInArrow(heads, "path string, grid array<double>, bands int, nodata double").orderBy("path").collect()
    if not rows:
        raise FileNotFoundError(f"nothing matches {path}")
    return [(r.path, Grid(*r.grid[:3], *(int(v) for v in r.grid[3:])), r.bands, r.nodata) for r in rows]


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def offset(source: Grid, target: Grid) -> tuple[int, int]:
    """(down, right): where the source's first cell lies on the target, whose cells must be the same but for a whole number of them."""
    down, right = (target.north - source.north) / source.res, (source.west - target.west) / source.res
    if source.res != target.res or abs(down - round(down)) > 1e-6 or abs(right - round(right)) > 1e-6:
        raise ValueError("the grids do not lie on each other: resample instead")
    return round(down), round(right)


def on_grid(cells: DataFrame, source: Grid, target: Grid) -> DataFrame:
    """Cells of a grid as cells of another, see ``offset``; those outside are left out."""
    down, right = offset(source, target)
    moved = cells.withColumns({"row": F.col("row") + down, "col": F.col("col") + right})
    return moved.filter((F.col("row") >= 0) & (F.col("row") < target.nrow) & (F.col("col") >= 0) & (F.col("col") < target.ncol))


def read_mosaic(spark: SparkSession, path: str, band: int = 1) -> tuple[DataFrame, Grid]:
    """((row, col, v), grid) of all files that the path or glob matches: of files on one cell the first by path that knows it.

    One plan for any number of files: a row for each file, with its place and
    rank, is broadcast. Files on other cells than the first one's raise
    ValueError.
    """
    files = geotiff_grids(spark, path)
    first = files[0][1]
    west, north = min(g.west for _, g, _, _ in files), max(g.north for _, g, _, _ in files)
    ncol = round((max(g.west + g.ncol * g.res for _, g, _, _ in files) - west) / first.res)
    nrow = round((north - min(g.north - g.nrow * g.res for _, g, _, _ in files)) / first.res)
    whole = Grid(west, north, first.res, nrow, ncol, first.epsg)
    if any(g.epsg != first.epsg for _, g, _, _ in files):
        raise ValueError("the files are in different reference systems")
    cells = read_geotiff(spark, path, [band]).withColumnRenamed(f"b{band}", "v")
    if len(files) == 1:
        return cells.select("row", "col", "v"), whole
    places = spark.createDataFrame([(p, n, *offset(g, whole)) for n, (p, g, _, _) in enumerate(files)], "path string, n int, down int, right int")
    moved = cells.filter(F.col("v").isNotNull()).join(F.broadcast(places), "path")
    moved = moved.select((F.col("row") + F.col("down")).alias("row"), (F.col("col") + F.col("right")).alias("col"), "v", "n")
    return moved.groupBy("row", "col").agg(F.min_by("v", "n").alias("v")), whole


def to_geotiff(df: DataFrame, path: str, grid: Grid, bands: list[str], nodata: float = -1.0, compress: bool = True, most: int = 50_000_000) -> None:
    """Writes a small raster as a float32 GeoTIFF on the driver, deflated in strips, with the bands' names as descriptions.

    Larger grids raise ValueError: those stay cell tables.
    """
    from terracell.sources.cells import with_sentinels

    if grid.nrow * grid.ncol * len(bands) > most:
        raise ValueError("the raster is too large for one file on the driver: write cells instead")
    data = np.full((grid.nrow, grid.ncol, len(bands)), nodata, dtype="<f4")
    for batch in with_sentinels(df.select("row", "col", *bands), nodata, *bands).toLocalIterator():
        data[batch["row"], batch["col"]] = [batch[b] for b in bands]
    n, high = len(bands), 64
    strips = [data[r : r + high].tobytes() for r in range(0, grid.nrow, high)]
    strips = [zlib.compress(s) for s in strips] if compress else strips
    names = "".join(f'<Item name="DESCRIPTION" sample="{k}" role="description">{b}</Item>' for k, b in enumerate(bands))
    described, text = f"<GDALMetadata>{names}</GDALMetadata>\0".encode(), f"{nodata:g}\0".encode()
    keys = struct.pack("<16H", 1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, grid.epsg)
    if grid.epsg in (0, 4326):
        keys = struct.pack("<16H", 1, 1, 0, 3, 1024, 0, 1, 2, 1025, 0, 1, 1, 2048, 0, 1, grid.epsg)
    places = struct.pack(f"<{len(strips)}I", *[0] * len(strips))
    tags = [
        (256, 4, 1, struct.pack("<I", grid.ncol)), (257, 4, 1, struct.pack("<I", grid.nrow)), (258, 3, n, struct.pack(f"<{n}H", *[32] * n)),
        (259, 3, 1, struct.pack("<H", 8 if compress else 1)), (262, 3, 1, struct.pack("<H", 1)), (273, 4, len(strips), places), (277, 3, 1, struct.pack("<H", n)),
        (278, 4, 1, struct.pack("<I", high)), (279, 4, len(strips), struct.pack(f"<{len(strips)}I", *map(len, strips))), (339, 3, n, struct.pack(f"<{n}H", *[3] * n)),
        (33550, 12, 3, struct.pack("<3d", grid.res, grid.res, 0)), (33922, 12, 6, struct.pack("<6d", 0, 0, 0, grid.west, grid.north, 0)), (34735, 3, 16, keys),
        (42112, 2, len(described), described), (42113, 2, len(text), text),
    ]
    at = 8 + 2 + 12 * len(tags) + 4
    start = at + sum(len(v) + len(v) % 2 for _, _, _, v in tags if len(v) > 4)
    offsets = struct.pack(f"<{len(strips)}I", *(start + sum(map(len, strips[:k])) for k in range(len(strips))))
    entries, blob = b"", b""
    for tag, kind, count, value in tags:
        value = offsets if tag == 273 else value
        if len(value) <= 4:
            entries += struct.pack("<HHI", tag, kind, count) + value.ljust(4, b"\0")
        else:
            entries += struct.pack("<HHII", tag, kind, count, at + len(blob))
            blob += value + b"\0" * (len(value) % 2)
    with open(path, "wb") as f:
        f.write(struct.pack("<2sHI", b"II", 42, 8) + struct.pack("<H", len(tags)) + entries + struct.pack("<I", 0) + blob + b"".join(strips))
