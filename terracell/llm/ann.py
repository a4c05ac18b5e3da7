"""Nearest neighbours by inner product over sharded, robust-pruned directed graphs (as in DiskANN).

Equal vectors are one point. Points are dealt by hash over shards; each shard
builds its own graph: the nearest points of the shard are proposed, and
relaxed pruning keeps those that no kept neighbour is much closer to, so edges
stay diverse. Edges lead both ways, so a point that is near to few others is
still found. Shards hold points of about the same norm (a band of norms), so
that within one the largest inner products are at the smallest angles, and the
graph is over directions. A query beams through every shard's graph; scores
are then taken exactly, in double precision. The recall of a beam falls with
the points of its graph, so shards have a bounded number of points at every
size, and a search task holds a shelf of many shards. Only points that may be
among a query's best so far are scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracell.llm.shared import discard, written

#: Near and far edges that a point chooses, and those it chooses among; relaxation of the pruning.
DEGREE, FAR, PROPOSED, ALPHA = 48, 2, 72, 1.2
#: Beam of a search, points of a beam that move at once, and points where searches enter.
SEARCH_BEAM, WIDTH, ENTRIES = 32, 8, 32
#: Points of a shard, on average at most; bytes of a shelf, about; shelves that a large enough table gets at least.
SHARD_POINTS, SHELF_BYTES, SHELVES = 2_000, 64 << 20, 8
#: Ratio of the norms in a band. Doubles have at most some 15,000 bands, which bounds their broadcast.
BAND = 1.2
#: Points moved together; queries that one search task holds, about.
BATCH, TASK_QUERIES = 256, 100_000
NEIGHBOURS = 20


def _greedy(points: np.ndarray, edges: tuple[np.ndarray, np.ndarray], entries: np.ndarray, targets: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, inner products) of the beam's points, nearest first, for each target; -1 where there are fewer. ``WIDTH`` points of a beam move at once."""
    n, size = len(targets), len(points)
    first, to = edges
    count = np.diff(first)
    beam = max(beam, len(entries))
    ids = np.full((n, beam), -1, dtype=np.int32)
    near = np.full((n, beam), -np.inf, dtype=np.float32)
    done = np.ones((n, beam), dtype=bool)
    ids[:, : len(entries)], near[:, : len(entries)], done[:, : len(entries)] = entries, targets @ points[entries].T, False
    order = np.argsort(-near, axis=1, kind="stable")
    ids, near, done = (np.take_along_axis(x, order, 1)[:, :beam] for x in (ids, near, done))
    seen, stamp = np.zeros(n * size, dtype=bool), np.empty(n * size, dtype=np.int32)
    seen[(np.arange(n)[:, None] * size + entries).ravel()] = True
    active = np.arange(n)
    while len(active):
        free = ~done[active]
        row, place = np.nonzero(free & (np.cumsum(free, axis=1) <= WIDTH))
        done[active[row], place] = True
        at = ids[active[row], place]
        some = count[at]
        end = np.cumsum(some)
        found = to[np.arange(end[-1]) - np.repeat(end - some - first[at], some)]
        row = np.repeat(row, some)
        cell = active[row] * size + found
        fresh = ~seen[cell]
        cell, found, row = cell[fresh], found[fresh], row[fresh]
        stamp[cell] = np.arange(len(cell), dtype=np.int32)
        once = stamp[cell] == np.arange(len(cell), dtype=np.int32)
        cell, found, row = cell[once], found[once], row[once]
        seen[cell] = True
        if len(found):
            some = np.bincount(row, minlength=len(active))
            end = np.cumsum(some)
            score = np.empty(len(found), dtype=np.float32)
            for q, low, high in zip(active.tolist(), (end - some).tolist(), end.tolist(), strict=True):
                np.dot(points.take(found[low:high], 0), targets[q], out=score[low:high])
            column = np.arange(len(found)) - (end - some)[row]
            more, more_ids = np.full((len(active), int(some.max())), -np.inf, dtype=np.float32), np.full((len(active), int(some.max())), -1, dtype=np.int32)
            more[row, column], more_ids[row, column] = score, found
            every = np.concatenate([near[active], more], 1)
            keep = np.argpartition(-every, beam - 1, axis=1)[:, :beam]
            keep = np.take_along_axis(keep, np.argsort(-np.take_along_axis(every, keep, 1), axis=1, kind="stable"), 1)
            near[active] = np.take_along_axis(every, keep, 1)
            ids[active] = np.take_along_axis(np.concatenate([ids[active], more_ids], 1), keep, 1)
            done[active] = np.take_along_axis(np.concatenate([done[active], more_ids < 0], 1), keep, 1)
        active = active[~done[active].all(1)]
    return ids, near


def _pruned(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, alpha: float) -> np.ndarray:
    """Of each point's candidates (-1: none), up to DEGREE diverse ones."""
    candidates = np.where(candidates == own[:, None], -1, candidates)
    order = np.sort(candidates, axis=1)
    candidates = order.copy()
    candidates[:, 1:][order[:, 1:] == order[:, :-1]] = -1
    at = points[candidates]
    to_own = ((at - points[own][:, None, :]) ** 2).sum(2)
    to_own[candidates < 0] = np.inf
    norm = (at**2).sum(2)
    between = np.maximum(norm[:, :, None] + norm[:, None, :] - 2 * at @ at.transpose(0, 2, 1), 0)
    alive = to_own.copy()
    found = np.full((len(own), DEGREE), -1, dtype=np.int64)
    rows = np.arange(len(own))
    for k in range(DEGREE):
        best = alive.argmin(1)
        some = np.isfinite(alive[rows, best])
        if not some.any():
            break
        found[some, k] = candidates[rows[some], best[some]]
        covered = alpha * alpha * between[rows, best] <= to_own
        covered[~some] = False
        alive[covered] = np.inf
        alive[rows, best] = np.inf
    return found


def build_graph(points: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first edge by point and the end, other ends, entries) of the robust-pruned graph of unit vectors, every edge both ways; deterministic."""
    n = len(points)
    random = np.random.default_rng(seed)
    chosen = np.empty((n, DEGREE), dtype=np.int64)
    for low in range(0, n, BATCH):
        own = np.arange(low, min(n, low + BATCH))
        most = min(PROPOSED, n)
        near = np.argpartition(-(points[own] @ points.T), most - 1, axis=1)[:, :most]
        chosen[own] = _pruned(points, own, near, ALPHA)
    # Far edges are kept unpruned: near ones alone may leave clusters apart.
    chosen = np.concatenate([chosen, random.integers(0, n, (n, FAR))], 1)
    source, target = np.repeat(np.arange(n), chosen.shape[1]), chosen.ravel()
    some = (target >= 0) & (target != source)
    pairs = np.unique(np.concatenate([source[some] * n + target[some], target[some] * n + source[some]]))
    first = np.searchsorted(pairs // n, np.arange(n + 1)).astype(np.int32)
    # The most central point, then always the one farthest from all entries so far: one in every cluster, while they last.
    entries = [int((points @ points.mean(0)).argmax())]
    nearest = points @ points[entries[0]]
    while len(entries) < min(ENTRIES, n):
        entries.append(int(nearest.argmin()))
        if nearest[entries[-1]] >= 1 - 1e-6:
            entries.pop()
            break
        nearest = np.maximum(nearest, points @ points[entries[-1]])
    return first, (pairs % n).astype(np.int32), np.array(entries, dtype=np.int32)


def _directions(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)  # squares of very small or large components stay finite
    return (scaled / np.sqrt((scaled**2).sum(1, keepdims=True))).astype(np.float32)


def band(vector: str) -> Column:
    """The band of a vector's norm; norm 1 is in the middle of band 0."""

    def log_norm(largest: Column) -> Column:
        return F.log(largest) + F.log(F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + (x / largest) * (x / largest))))

    # An array of one binds the largest component, which would else be found again for every component.
    norm = F.transform(F.array(F.array_max(F.transform(vector, F.abs))), log_norm)[0]
    return F.floor(norm / float(np.log(BAND)) + 0.5).cast("int")


def _usable(name: str) -> Column:
    whole = F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(name).isNotNull() & F.coalesce(whole, F.lit(False)) & F.exists(name, lambda x: x != 0)


def _bytes(vectors: pa.ListArray) -> list[bytes]:
    """Vectors in the floats of their own type, little-endian: floats stay half as long as doubles."""
    kind = "<f4" if pa.types.is_float32(vectors.type.value_type) else "<f8"
    return [x.values.to_numpy(zero_copy_only=False).astype(kind).tobytes() for x in vectors]


def _doubles(packed: bytes, dim: int, rows: int) -> np.ndarray:
    return np.frombuffer(packed, dtype=f"<f{len(packed) // (dim * rows)}").reshape(rows, dim).astype(np.float64)


def _whole(points: int) -> str:
    return "<u2" if points <= 1 << 16 else "<u4"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal vectors of a batch as one row with its NEIGHBOURS + 1 smallest ids: a query needs no more of them."""
    for batch in batches:
        ids, shards = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        order = np.argsort(ids, kind="stable")
        points: dict[tuple[int, bytes], list[int]] = {}
        raws = _bytes(batch.column(2))
        for i in order.tolist():
            kept = points.setdefault((shards[i], raws[i]), [])
            if len(kept) <= NEIGHBOURS and (not kept or kept[-1] != ids[i]):
                kept.append(int(ids[i]))
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in points], pa.int32()), pa.array([v for _, v in points], pa.binary()), pa.array(list(points.values()), pa.list_(pa.int64()))], names=["shard", "vector", "ids"])


def _build(table: pa.Table) -> pa.Table:
    one = table.slice(0, 1)
    dim = one.column("dim")[0].as_py()
    points: dict[bytes, set[int]] = {}
    for raw, ids in zip(table.column("vector").to_pylist(), table.column("ids").to_pylist(), strict=True):
        points.setdefault(raw, set()).update(ids)
    listed = sorted(points)
    packed = b"".join(listed)
    vectors = _doubles(packed, dim, len(listed))
    ids = np.full((len(listed), NEIGHBOURS + 1), np.iinfo(np.int64).max, dtype=np.int64)
    for row, raw in enumerate(listed):
        kept = sorted(points[raw])[: NEIGHBOURS + 1]
        ids[row, : len(kept)] = kept
    first, to, entries = build_graph(_directions(vectors))
    return pa.table(
        {
            "dim": one.column("dim"),
            "shelf": one.column("shelf"),
            "shard": one.column("shard"),
            "entries": pa.array([entries.tobytes()], pa.binary()),
            "vectors": pa.array([packed], pa.binary()),
            "first": pa.array([first.tobytes()], pa.binary()),
            "edges": pa.array([to.astype(_whole(len(listed))).tobytes()], pa.binary()),
            "ids": pa.array([ids.tobytes()], pa.binary()),
        }
    )


def _search(index: pa.Table, queries: pa.Table) -> pa.Table:
    """The nearest found of every query over a shelf of shards."""
    kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if not index.num_rows or not queries.num_rows:
        return kind.empty_table()
    asked = queries.column("query_id").to_numpy()
    own = _doubles(b"".join(queries.column("vector").to_pylist()), index.column("dim")[0].as_py(), len(asked))
    none = np.iinfo(np.int64).max
    ids, scores = np.full((len(asked), NEIGHBOURS), none), np.full((len(asked), NEIGHBOURS), -np.inf)
    for shard in range(index.num_rows):
        _search_shard({k: index.column(k)[shard].as_py() for k in ("dim", "entries", "vectors", "first", "edges", "ids")}, asked, own, ids, scores)
    row, place = np.nonzero(ids != none)
    return pa.table([asked[row], ids[row, place], scores[row, place]], schema=kind)


def _search_shard(shard: dict, asked: np.ndarray, own: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
    """Merges a shard's nearest into ids and scores, which hold each query's NEIGHBOURS best so far."""
    first = np.frombuffer(shard["first"], dtype=np.int32)
    vectors = _doubles(shard["vectors"], shard["dim"], len(first) - 1)
    edges = first, np.frombuffer(shard["edges"], dtype=_whole(len(vectors))).astype(np.int32)
    entries = np.frombuffer(shard["entries"], dtype=np.int32)
    held = np.frombuffer(shard["ids"], dtype=np.int64).reshape(len(vectors), NEIGHBOURS + 1)
    points, none = _directions(vectors), np.iinfo(np.int64).max
    for low in range(0, len(asked), BATCH):
        some = own[low : low + BATCH]
        near, _ = _greedy(points, edges, entries, _directions(some), SEARCH_BEAM)
        row, place = np.nonzero(near >= 0)
        point = near[row, place]
        score = (vectors[point] * some[row]).sum(1)
        best_ids, best = ids[low : low + BATCH], scores[low : low + BATCH]
        may = score >= best[row, -1]  # a tie may have the smaller id
        row, point, score = row[may], point[may], score[may]
        if not len(row):
            continue
        fine = held[point] != none
        candidate, found = held[point][fine], np.repeat(score, fine.sum(1))
        row = np.repeat(row, fine.sum(1))
        other = candidate != asked[low + row]
        changed = np.unique(row[other])
        if not len(changed):
            continue
        old = best_ids[changed] != none
        old_row = np.repeat(changed, old.sum(1))
        row, candidate, found = np.concatenate([row[other], old_row]), np.concatenate([candidate[other], best_ids[changed][old]]), np.concatenate([found[other], best[changed][old]])
        by = np.lexsort((candidate, -found, row))
        row, candidate, found = row[by], candidate[by], found[by]
        # Rows of one id may have several vectors; equal pairs lie side by side and count once.
        once = np.ones(len(row), dtype=bool)
        once[1:] = (row[1:] != row[:-1]) | (candidate[1:] != candidate[:-1]) | (found[1:] != found[:-1])
        row, candidate, found = row[once], candidate[once], found[once]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        kept = rank < NEIGHBOURS
        best_ids[row[kept], rank[kept]], best[row[kept], rank[kept]] = candidate[kept], found[kept]


def dealt(total: int, dim: int = 64) -> tuple[int, int]:
    """(shelves, shards) for so many vectors of so many components: a point takes its vector, its edges and its ids."""
    least = max(1, min(SHELVES, -(-total // 1000)))
    return max(least, -(-total * (8 * dim + 8 * (DEGREE + FAR) + 8 * (NEIGHBOURS + 1)) // SHELF_BYTES)), max(least, -(-total // SHARD_POINTS))


def neighbours(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the NEIGHBOURS nearest found of every query row, by inner product.

    Queries search among vectors of their own length. Vectors that are null,
    zero, or hold null or non-finite components take no part, nor do rows with
    a null id. A query never finds rows of its own id. Ties go to the smaller
    id; repeated rows count once; a query id with several vectors asks with the
    least. An empty table gives an empty one. Every row is indexed: the graph
    is a written table, one row per shard.
    """
    kind, width = ("float", 4) if df.schema[vector].dataType.elementType == T.FloatType() else ("double", 8)
    rows = df.filter(F.col(key).isNotNull() & _usable(vector)).select(F.col(key).cast("long").alias("id"), F.transform(vector, lambda x: x.cast(kind)).alias("vector"), is_query.alias("asks"))
    rows = written(rows.withColumn("band", band("vector")), "ann-rows")
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.max(F.size("vector")), F.lit(1)).alias("dim")).first()
    shelves, _ = dealt(size["rows"], size["dim"])
    # Shards are numbered through all bands: at most one partly filled shard more for each band.
    sizes = rows.groupBy("band").agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(SHARD_POINTS)), F.least(F.lit(SHELVES), F.ceil(F.count(F.lit(1)) / 1000))).alias("shards"))
    before = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    sizes = written(sizes.withColumn("first", F.coalesce(F.sum("shards").over(before), F.lit(0))), "ann-bands")
    points = rows.join(F.broadcast(sizes), "band").withColumn("shard", (F.col("first") + F.pmod(F.xxhash64("vector"), F.col("shards"))).cast("int"))
    points = points.select("id", "shard", "vector").mapInArrow(_packed, "shard int, vector binary, ids array<long>")
    points = points.withColumns({"dim": F.floor(F.octet_length("vector") / width).cast("int"), "shelf": F.pmod("shard", F.lit(shelves)).cast("int")})
    index = written(points.groupBy("dim", "shelf", "shard").applyInArrow(_build, "dim int, shelf int, shard int, entries binary, vectors binary, first binary, edges binary, ids binary"), "ann-index")

    # Rows of one id that differ are one query: the least vector.
    asked = written(rows.filter("asks").groupBy("id").agg(F.min("vector").alias("vector")).mapInArrow(_binary, "query_id long, vector binary"), "ann-asked")
    discard(sizes, rows)
    parts = max(1, -(-asked.count() // TASK_QUERIES))
    asked = asked.select("query_id", "vector", F.floor(F.octet_length("vector") / width).cast("int").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))).alias("shelf"), F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int").alias("part"))
    held = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    found = held.groupBy("dim", "shelf", "part").cogroup(asked.groupBy("dim", "shelf", "part")).applyInArrow(_search, "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(nearest))
    return ranked.filter(F.col("rank") <= NEIGHBOURS).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _binary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_bytes(batch.column(1)), pa.binary())], names=["query_id", "vector"])
