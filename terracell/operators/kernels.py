"""Array kernels over batches of features and over tiles of cells, as numpy arrays.

They do what expressions would have to do cell by cell: points in rings,
rotated boxes, sums over discs, discs over cells, nearest sources in a row.
Each works on one batch or one tile at a time, so memory is bounded by these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pairs of a cell and an edge that are tested at a time.
PAIRS = 1 << 20
#: Sums over discs go by Fourier transform from this radius on.
FOURIER = 12


def ring_arrays(rings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, x, y, follows) of a column of rings, or of arrays of rings: points by feature, and the point that each one's edge leads to.

    Null rings and arrays have no points.
    """
    def sizes(column: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)

    lengths, points = sizes(rings), rings.flatten()
    inner = lengths
    if pa.types.is_list(points.type):
        inner, points = sizes(points), points.flatten()
        ends = np.concatenate(([0], np.cumsum(inner)))
        lengths = np.diff(ends[np.concatenate(([0], np.cumsum(lengths)))])
    x, y = (pc.struct_field(points, k).cast(pa.float64()).to_numpy(zero_copy_only=False) for k in ("x", "y"))
    return lengths, x, y, _follows(inner)


def _follows(lengths: np.ndarray) -> np.ndarray:
    """Of each point the next of its ring; the last leads back to the first."""
    some = lengths[lengths > 0]
    follows = np.arange(int(some.sum())) + 1
    follows[np.cumsum(some) - 1] = np.cumsum(some) - some
    return follows


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place): each of ``counts`` many members with its owner's number and its place in it."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def cells_of_rings(rings: pa.Array, west: float, north: float, res: float, ncol: int, nrow: int, reach: float = 0.0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(feature, row, col) of every cell whose centre lies in a feature (even-odd over its rings; each edge owns its lower end) or at most ``reach`` from it."""
    lengths, x, y, follows = ring_arrays(rings)
    feature = np.flatnonzero(lengths)
    if not len(feature):
        return
    lengths = lengths[feature]
    first = np.cumsum(lengths) - lengths
    bx, by = x[follows], y[follows]

    def index(v, most):
        return np.clip(np.floor(v), 0, most - 1).astype(np.int64)

    c0, c1 = index((np.minimum.reduceat(x, first) - reach - west) / res, ncol), index((np.maximum.reduceat(x, first) + reach - west) / res, ncol)
    r0, r1 = index((north - np.maximum.reduceat(y, first) - reach) / res, nrow), index((north - np.minimum.reduceat(y, first) + reach) / res, nrow)
    unit, place = _spread(r1 - r0 + 1)  # a unit is one raster row of one feature
    unit_row, width = r0[unit] + place, (c1 - c0 + 1)[unit]
    total = np.cumsum(width * lengths[unit])
    start = 0
    while start < len(unit):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + PAIRS, side="right")))
        own, col = _spread(width[start:stop])
        row, ring = unit_row[start:stop][own], unit[start:stop][own]
        col = c0[ring] + col
        cell, edge = _spread(lengths[ring])
        edge += first[ring][cell]
        px, py = (west + (col + 0.5) * res)[cell], (north - (row + 0.5) * res)[cell]
        ax, ay, ex, ey = x[edge], y[edge], bx[edge], by[edge]
        starts = np.cumsum(lengths[ring]) - lengths[ring]
        with np.errstate(divide="ignore", invalid="ignore"):
            crosses = ((ay > py) != (ey > py)) & (px < (ex - ax) * (py - ay) / (ey - ay) + ax)
            hit = np.add.reduceat(crosses.astype(np.int64), starts) % 2 == 1
            if reach:
                dx, dy = ex - ax, ey - ay
                t = np.nan_to_num(np.clip(((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy), 0.0, 1.0), nan=0.0)
                fx, fy = px - (ax + t * dx), py - (ay + t * dy)
                hit |= np.minimum.reduceat(fx * fx + fy * fy, starts) <= reach * reach
        yield feature[ring[hit]], row[hit], col[hit]
        start = stop


def smallest_boxes(rings: pa.Array, step: int = 5) -> pa.StructArray:
    """struct(key, angle, length, width) of each ring's least bounding box over angles from 0 below 180; the first of equal ones, areas to 6 places."""
    lengths, x, y, _ = ring_arrays(rings)
    some = lengths > 0
    first = (np.cumsum(lengths) - lengths)[some]
    n = int(some.sum())
    best = np.full(n, np.inf)
    angle, length, width = np.zeros(n, dtype=np.int32), np.zeros(n), np.zeros(n)
    for degrees in range(0, 180, step) if n else ():
        cos, sin = np.cos(np.radians(float(degrees))), np.sin(np.radians(float(degrees)))
        u, v = x * cos - y * sin, x * sin + y * cos
        long, wide = (np.maximum.reduceat(t, first) - np.minimum.reduceat(t, first) for t in (u, v))
        area = np.round(long * wide, 6)
        wins = area < best
        best[wins], angle[wins], length[wins], width[wins] = area[wins], degrees, long[wins], wide[wins]
    at = np.cumsum(some) - 1
    columns = [pa.array((values[at] if n else np.zeros(len(some), values.dtype)), mask=~some) for values in (best, angle, length, width)]
    return pa.StructArray.from_arrays(columns, names=["key", "angle", "length", "width"], mask=pa.array(~some))


def clip_rings(rings: pa.Array, box: tuple[float, float, float, float]) -> pa.ListArray:
    """The part of each ring inside a closed box (west, south, east, north), one side after another (Sutherland and Hodgman); empty outside.

    Concave rings may keep coincident edges along the box, which add no area.
    """
    lengths, x, y, follows = ring_arrays(rings)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    west, south, east, north = box
    for axis, limit, above in (("x", west, True), ("x", east, False), ("y", south, True), ("y", north, False)):
        bx, by = x[follows], y[follows]
        a, b = (x, bx) if axis == "x" else (y, by)
        starts_in, ends_in = (a >= limit, b >= limit) if above else (a <= limit, b <= limit)
        with np.errstate(divide="ignore", invalid="ignore"):
            s = (limit - a) / (b - a)
            meets = np.column_stack([x + s * (bx - x), bx]).ravel(), np.column_stack([y + s * (by - y), by]).ravel()
        kept = np.column_stack([starts_in != ends_in, ends_in]).ravel()  # where an edge crosses the side, then its end
        x, y, owner = meets[0][kept], meets[1][kept], np.repeat(owner, 2)[kept]
        lengths = np.bincount(owner, minlength=len(lengths))
        follows = _follows(lengths)
    points = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])
    offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, points, mask=rings.is_null())


def disc(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (i, j) with i * i + j * j <= k * k, by row and column."""
    i, j = np.mgrid[-k : k + 1, -k : k + 1]
    inside = i * i + j * j <= k * k
    return i[inside], j[inside]


def disc_sums(layers: list[np.ndarray], at: tuple[np.ndarray, np.ndarray], k: int, weight) -> list[np.ndarray]:
    """For each layer its sum of weight(d2) * value over the disc of radius k, without the centre, around the places ``at``."""
    i, j = disc(k)
    nrow, ncol = layers[0].shape
    apart = ((i != 0) | (j != 0)) & (np.abs(i) < nrow) & (np.abs(j) < ncol)  # farther ones meet no cell of the tile
    i, j = i[apart], j[apart]
    w = weight((i * i + j * j).astype(float))
    r, c = at
    if k < FOURIER:
        padded = [np.pad(layer, k) for layer in layers]
        sums = [np.zeros(len(r)) for _ in layers]
        for di, dj, one in zip(i.tolist(), j.tolist(), w.tolist(), strict=True):
            for total, layer in zip(sums, padded, strict=True):
                total += one * layer[r + (k + di), c + (k + dj)]
        return sums
    shape = tuple(_smooth(n + min(k, n)) for n in layers[0].shape)
    kernel = np.zeros(shape)
    kernel[i % shape[0], j % shape[1]] = w
    turned = np.fft.rfft2(kernel)
    return [np.fft.irfft2(np.fft.rfft2(layer, shape) * turned, shape)[r, c] for layer in layers]


def box_sums(layer: np.ndarray, k: int) -> np.ndarray:
    """Sums over windows of 2k + 1 cells, cut at the edges: one axis after the other, by differences of running sums."""
    for axis in (0, 1):
        n = layer.shape[axis]
        running = np.concatenate([np.zeros_like(layer.take([0], axis)), np.cumsum(layer, axis)], axis)
        at = np.arange(n)
        layer = running.take(np.minimum(at + k + 1, n), axis) - running.take(np.maximum(at - k, 0), axis)
    return layer


def _smooth(n: int) -> int:
    """The next number without prime factors over 5: transforms of it are fast."""
    while True:
        rest = n
        for p in (2, 3, 5):
            while rest % p == 0:
                rest //= p
        if rest == 1:
            return n
        n += 1


def inverse_distance(values: np.ndarray, at: tuple[np.ndarray, np.ndarray], k: int) -> np.ndarray:
    """Inverse-square-distance mean of the known cells within k of the places ``at``; nan where there is none."""
    known = ~np.isnan(values)
    weighted, weights = disc_sums([np.where(known, values, 0.0), known.astype(float)], at, k, lambda d2: 1 / d2)
    count = disc_sums([known.astype(float)], at, k, np.ones_like)[0]
    return np.where(count > 0.5, weighted / np.where(count > 0.5, weights, 1.0), np.nan)


def majority(values: np.ndarray, at: tuple[np.ndarray, np.ndarray], k: int) -> np.ndarray:
    """The commonest known value within k of the places ``at``, the smallest on ties; nan where there is none."""
    best, most = np.full(len(at[0]), np.nan), np.zeros(len(at[0]))
    for value in np.unique(values[~np.isnan(values)]):
        count = np.rint(disc_sums([(values == value).astype(float)], at, k, np.ones_like)[0])
        wins = count > most
        best[wins], most[wins] = value, count[wins]
    return best


def nearest_in_row(own: np.ndarray, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(d2, source row, source column) of each cell of a raster row; own is the nearest source row in its column (-1: none).

    The best column never moves back as cells move on, whatever breaks ties
    (here the smaller source row, then column), so cells are solved from the
    coarsest to the finest, each between its solved neighbours' columns.
    """
    width = len(own)
    columns = np.flatnonzero(own >= 0)
    if not len(columns):
        return np.zeros(width, np.int64), np.full(width, -1), np.full(width, -1)
    g2 = (own[columns] - row) ** 2
    by_rank = np.lexsort((columns, own[columns]))
    rank = np.empty(len(columns), np.int64)
    rank[by_rank] = np.arange(len(columns))
    choice, best = np.zeros(width, np.int64), np.zeros(width, np.int64)
    stride = 1 << (width.bit_length() - 1)
    while stride:
        x = np.arange(stride - 1, width, 2 * stride)
        low = np.where(x >= stride, choice[np.maximum(x - stride, 0)], 0)
        high = np.where(x + stride < width, choice[np.minimum(x + stride, width - 1)], len(columns) - 1)
        cell, place = _spread(high - low + 1)
        at = low[cell] + place
        d2 = g2[at] + (x[cell] - columns[at]) ** 2
        starts = np.cumsum(high - low + 1) - (high - low + 1)
        best[x] = np.minimum.reduceat(d2, starts)
        choice[x] = by_rank[np.minimum.reduceat(np.where(d2 == best[x][cell], rank[at], len(columns)), starts)]
        stride //= 2
    return best, own[columns[choice]], columns[choice]


def widest_discs(r2: np.ndarray, alloc: np.ndarray, present: np.ndarray, cap: float) -> tuple[np.ndarray, np.ndarray]:
    """(r2, height) by cell: of the discs |p - q|^2 < r2[q] that cover it the largest, the first by row and column of equal ones; nan where none does.

    r2 is 0 or less where there is no centre and at most cap; height is the
    mean of alloc over the disc's present cells. A centre whose disc lies in
    that of a centre within two cells decides nothing and is left out. Discs
    of the same size are painted together, smaller ones first; those of the
    cap, of which wide spaces have very many, are looked up row by row.
    """
    k = int(np.ceil(np.sqrt(cap))) if cap > 0 else 0
    nrow, ncol = r2.shape
    centre = r2 > 0
    radius = np.sqrt(np.where(centre, r2, 0.0))
    needed = centre.copy()
    for i in range(-2, 3):
        for j in range(-2, 3):
            if i or j:
                there = np.zeros_like(radius)
                rows, cols = (slice(max(0, -i), nrow - max(0, i)), slice(max(0, i), nrow - max(0, -i))), (slice(max(0, -j), ncol - max(0, j)), slice(max(0, j), ncol - max(0, -j)))
                there[rows[0], cols[0]] = radius[rows[1], cols[1]]
                needed &= ~(there >= radius + np.hypot(i, j) + 1e-9)
    pad = k + 1
    wide = ncol + 2 * pad
    winner = np.full((nrow + 2 * pad) * wide, -1, dtype=np.int64)
    flat = (np.arange(nrow)[:, None] + pad) * wide + np.arange(ncol) + pad
    at, size = flat[needed], r2[needed]
    order = np.lexsort((-at, size))
    at, size = at[order], size[order]
    cuts = np.flatnonzero(np.diff(size)) + 1
    for same, of in zip(np.split(at, cuts), np.split(size, cuts), strict=True):
        if not len(same) or of[0] >= cap:
            continue
        i, j = _open_disc(of[0])
        for low in range(0, len(same), max(1, PAIRS // len(i))):
            some = same[low : low + max(1, PAIRS // len(i))]
            winner[(some[:, None] + (i * wide + j)[None, :]).ravel()] = np.repeat(some, len(i))
    if len(size) and size[-1] >= cap:
        mark = np.zeros((nrow + 2 * pad) * wide, dtype=bool)
        mark[at[size >= cap]] = True
        mark = mark.reshape(-1, wide)
        follows = np.where(mark, np.arange(wide), wide * 2)
        follows = np.minimum.accumulate(follows[:, ::-1], axis=1)[:, ::-1]
        p = flat.ravel()
        row, col = p // wide, p % wide
        for i in range(-k, k + 1):
            if i * i >= cap:
                continue
            reach = int(np.ceil(np.sqrt(cap - i * i))) - 1
            found = follows[row + i, col - reach]
            hit = found <= col + reach
            winner[p[hit]] = (row[hit] + i) * wide + found[hit]
            row, col, p = row[~hit], col[~hit], p[~hit]
    won = winner[flat]
    centres = np.unique(won[won >= 0])
    known = present & ~np.isnan(alloc)
    sums, counts = (np.pad(np.cumsum(np.pad(layer, ((pad, pad), (pad, pad))), axis=1), ((0, 0), (1, 0))) for layer in (np.where(known, alloc, 0.0), known.astype(np.int64)))
    crow, ccol = centres // wide, centres % wide
    csize = r2[crow - pad, ccol - pad]
    total, number = np.zeros(len(centres)), np.zeros(len(centres))
    for i in range(-k, k + 1):
        some = np.flatnonzero(csize > i * i)
        if len(some):
            reach = np.ceil(np.sqrt(csize[some] - i * i)).astype(np.int64) - 1
            row, left, right = crow[some] + i, ccol[some] - reach, ccol[some] + reach + 1
            total[some] += sums[row, right] - sums[row, left]
            number[some] += counts[row, right] - counts[row, left]
    mean = np.where(number > 0, total / np.maximum(number, 1), np.nan)
    index = np.searchsorted(centres, won)
    index = np.minimum(index, max(0, len(centres) - 1))
    if not len(centres):
        return np.full(r2.shape, np.nan), np.full(r2.shape, np.nan)
    return np.where(won >= 0, csize[index], np.nan), np.where(won >= 0, mean[index], np.nan)


def _open_disc(r2: float) -> tuple[np.ndarray, np.ndarray]:
    k = int(np.ceil(np.sqrt(r2)))
    i, j = np.mgrid[-k : k + 1, -k : k + 1]
    inside = i * i + j * j < r2
    return i[inside], j[inside]
