"""Exact n-gram Jaccard join: prefix trees over blocks of sets that can link.

Documents become sets of word n-grams (64-bit hashes). Documents with equal
sets are one set. Two sets of a given similarity differ in few members, so if
members are dealt by hash over more parts than that, some part is the same in
both: sets that share a part's signature are candidates. Signatures only
decide which sets are looked at together; they lose no link (see
``signatures``). The components of candidates are blocks; each block's owner
inserts its sets into a prefix tree and finds the links, exactly.

Members that very many documents have are left out of the parts, which only
routes: links are always decided on whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracell.llm.components import components
from terracell.llm.prefix_trie import Union, linked
from terracell.llm.secrets import text_bytes
from terracell.llm.shared import discard, lean, release, share_join, slices, small, written
from terracell.llm.shingles import U, mixed, shingle_sets

#: Frequent members that parts leave out, at most: a bound on what is broadcast; any choice gives the same links.
FREQUENT = 65_536
#: Counts of a member in one slice below this are not reported for that list.
REPORTED = 3
#: Signatures that a candidate task sorts, and members that a block's owner holds, about.
TASK_SIGNATURES = 400_000
TASK_MEMBERS = 400_000
#: Signatures that a dealing task gathers before it combines them.
GATHERED = 1_000_000
#: Blocks with more members are dealt over chunks, and each pair of chunks is one task.
BLOCK_MEMBERS = 4_000_000
#: Levels span three steps of size.
STEPS = 3


class Levels:
    """Size classes [low, high] such that any two sets that can link are together in one of them."""

    def __init__(self, percent: int, largest: int):
        self.percent = percent
        self.low, self.high = [1], []
        ratio = (percent / 100) ** STEPS
        while True:
            last = self.high[-1] if self.high else 0
            self.high.append(max(int(self.low[-1] / ratio), last + 1))
            if self.high[-1] >= largest:
                break
            self.low.append(max(1, -(-percent * (self.high[-1] + 1) // 100)))
        self.strong, self.spare = self._strength()
        self.parts = [math.ceil(self.spare * (self.differ(2 * h) + 1)) + 1 for h in self.high]

    def differ(self, both: int) -> int:
        """The most members in which two linked sets with ``both`` members together differ."""
        return (100 - self.percent) * both // (100 + self.percent)

    def differ_from_any(self, n: int, level: int) -> int:
        return self.differ(n + min(self.high[level], 100 * n // self.percent))

    def _strength(self) -> tuple[int, float]:
        """Members that a part needs to count, and by how much parts outnumber differences, so that most sets have enough such parts."""
        for strong in (3, 2):
            for spare in (1.05, 1.2):
                load = (100 + self.percent) / (2 * (100 - self.percent)) / spare if self.percent < 100 else 1e9
                fewer = sum(math.exp(-load) * load**k / math.factorial(k) for k in range(strong)) if load < 700 else 0.0
                if spare * (1 - fewer) > 1.02:
                    return strong, spare
        return 1, 1.5

    def of(self, n: int) -> list[int]:
        first = int(np.searchsorted(self.high, n, side="left"))
        return [k for k in range(first, len(self.low)) if self.low[k] <= n <= self.high[k]] if n else []


def signatures(tokens: np.ndarray, frequent: np.ndarray, levels: Levels) -> np.ndarray:
    """Signatures of one set; two linked, different sets share at least one.

    In each size class that has both sets, members are dealt over ``parts``
    parts. The sets differ in at most d members, which touch at most d parts.
    If a set has more than d parts of ``strong`` members or more, one of them
    is untouched, so it is the same in the other set, and both emit its
    signature. A set with no more such parts than its d also emits the members
    of its prefix in one global order; if a pair has no strong part in common,
    both of its sets are of this kind, and prefixes of linked sets share a
    member. Frequent members are left out of parts (which can only lessen the
    differences) and come last in the global order.
    """
    n = len(tokens)
    at = np.searchsorted(frequent, tokens)
    rare = np.ones(n, dtype=bool) if not len(frequent) else frequent[np.minimum(at, len(frequent) - 1)] != tokens
    own = tokens[rare]
    scrambled = mixed(own + U(0x2545F4914F6CDD1D))
    high = own >> U(32)
    found, short = [], False
    for level in levels.of(n):
        most = levels.differ_from_any(n, level)
        if not most:
            continue  # only equal sets link
        parts = levels.parts[level]
        part = ((high * U(parts)) >> U(32)).astype(np.int64)
        count = np.bincount(part, minlength=parts)
        strong = np.flatnonzero(count >= levels.strong)
        total = np.zeros(parts, dtype=np.uint64)
        np.add.at(total, part, scrambled)
        found.append(mixed(total[strong] ^ mixed(strong.astype(np.uint64) + U((level + 1) << 40))))
        short |= len(strong) <= most
    if short:
        prefix = np.concatenate([own, tokens[~rare]])[: n - -(-levels.percent * n // 100) + 1]
        found.append(mixed(prefix ^ U(0xA0761D6478BD642F)))
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def _sets(batch: pa.RecordBatch, column: int, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, first, last) of all rows of a batch: row i's set is tokens[first[i]:last[i]]."""
    data, starts, stops = text_bytes(batch.column(column))
    text, tokens = shingle_sets(data, starts, stops, words)
    row = np.arange(len(starts))
    return tokens, np.searchsorted(text, row, side="left"), np.searchsorted(text, row, side="right")


def _sums(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.add.accumulate(values)))
    return (total[last] - total[first]).astype(np.int64)


def _describe(words: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            tokens, first, last = _sets(batch, 2, words)
            n = len(first)
            value, docs = np.unique(tokens, return_counts=True)
            often = docs >= REPORTED
            value, docs = value[often], docs[often]
            m = len(value)
            columns = {
                "doc_id": pa.concat_arrays([batch.column(0), pa.nulls(m, pa.int64())]),
                "text_hash": pa.concat_arrays([batch.column(1), pa.nulls(m, pa.int64())]),
                "n": pa.concat_arrays([pa.array(last - first, pa.int64()), pa.nulls(m, pa.int64())]),
                "one": pa.concat_arrays([pa.array(_sums(mixed(tokens), first, last)), pa.nulls(m, pa.int64())]),
                "two": pa.concat_arrays([pa.array(_sums(mixed(tokens ^ U(0x1F83D9ABFB41BD6B)), first, last)), pa.nulls(m, pa.int64())]),
                "token": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(value.astype(np.int64))]),
                "docs": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(docs, pa.int64())]),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return lean(describe)


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs without repetition, by a, then b."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.ones(len(a), dtype=bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[fresh], b[fresh]


def _roots(signature: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, roots): owners that share a signature, directly or through others, with the least of them each."""
    signature, owner = _distinct(signature, owner)
    fresh = np.ones(len(signature), dtype=bool)
    fresh[1:] = signature[1:] != signature[:-1]
    least = owner[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] if len(owner) else owner
    apart = owner != least
    high, low = _distinct(owner[apart], least[apart])
    nodes, index = np.unique(np.concatenate([high, low]), return_inverse=True)
    union = Union(len(nodes))
    for a, b in zip(index[: len(high)].tolist(), index[len(high) :].tolist(), strict=True):
        union.join(a, b)
    return nodes, nodes[np.array([union.find(i) for i in range(len(nodes))], dtype=np.int64)] if len(nodes) else nodes


def _combined(signature: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and owners with the same components, but each signature once for each component of these rows.

    Owners that meet here are replaced by their root, so a signature that all
    share is one row; each such owner keeps one signature, made from its root,
    that ties it to the root.
    """
    nodes, roots = _roots(signature, owner)
    if not len(nodes):
        return signature, owner
    at = np.minimum(np.searchsorted(nodes, owner), len(nodes) - 1)
    root = np.where(nodes[at] == owner, roots[at], owner)
    tie = mixed(roots.astype(np.uint64) ^ U(0x5851F42D4C957F2D))
    return _distinct(np.concatenate([signature, tie]), np.concatenate([root, nodes]))


def _deal(words: int, frequent: np.ndarray, levels: Levels, buckets: int):
    def packed(signatures: list[np.ndarray], owners: list[np.ndarray]) -> pa.RecordBatch:
        signature, owner = _combined(np.concatenate(signatures), np.concatenate(owners))
        bucket = (((signature >> U(32)) * U(buckets)) >> U(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        signature, owner, bucket = signature[order], owner[order], bucket[order]
        present, starts = np.unique(bucket, return_index=True)
        ends = np.append(starts[1:], len(bucket))
        rows = [(signature[a:b].tobytes(), owner[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(present, pa.int64()), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "signatures", "owners"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_by, count = [], [], 0
        for batch in slices(batches, 1):
            tokens, first, last = _sets(batch, 1, words)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found = [signatures(tokens[a:b], frequent, levels) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            sizes = [len(s) for s in found]
            if not sum(sizes):
                continue
            held.append(np.concatenate(found))
            held_by.append(np.repeat(ids, sizes).astype(np.int64))
            count += sum(sizes)
            if count > GATHERED:
                yield packed(held, held_by)
                held, held_by, count = [], [], 0
        if count:
            yield packed(held, held_by)

    return lean(deal)


def _meet(table: pa.Table) -> pa.Table:
    """Of each signature's owners, links that span them, contracted over the whole bucket."""
    signature = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in table.column("signatures").to_pylist()])
    owner = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in table.column("owners").to_pylist()])
    nodes, roots = _roots(signature, owner)
    apart = nodes != roots
    return pa.table({"a": pa.array(nodes[apart], pa.int64()), "b": pa.array(roots[apart], pa.int64())})


def _members(words: int):
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3):
            tokens, first, last = _sets(batch, 3, words)
            packed = [tokens[a:b].tobytes() for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(packed, pa.binary())], names=["doc_id", "block", "chunks", "members"])

    return lean(members)


def _owner(percent: int):
    def own(table: pa.Table) -> pa.Table:
        a, b = [], []
        ids, blocks = table.column("doc_id").to_numpy(), table.column("block").to_numpy()
        packed = table.column("members").to_pylist()
        order = np.lexsort((ids, blocks))
        cuts = np.flatnonzero(np.diff(blocks[order])) + 1
        for rows in np.split(order, cuts):
            links = linked([np.frombuffer(packed[i], dtype=np.uint64) for i in rows], percent)
            a += [ids[rows[i]] for i, _ in links]
            b += [ids[rows[j]] for _, j in links]
        del packed
        release()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return own


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """One narrow row for each row of df: doc_id, n_shingles, component_id, set_id.

    Sets of ``words``-word shingles of the lower-cased whole text (a shorter
    text is one shingle) link when 100 * intersection >= percent * union;
    component_id is the smallest doc_id reachable by links, set_id the
    smallest with an equal set. Texts that are null or without words have an
    empty set, link with nothing and are their own component. Rows with a null
    doc_id take no part: component_id and set_id are null. Rows with one
    doc_id are one document. Other columns are ignored; an empty table gives
    an empty one.
    """
    source = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    described = source.select("doc_id", "text_hash", "text").mapInArrow(_describe(words), "doc_id long, text_hash long, n long, one long, two long, token long, docs long")
    described = written(described, "ngram-docs")
    docs = described.filter(F.col("token").isNull()).select("doc_id", "text_hash", "n", "one", "two")
    often = described.filter(F.col("token").isNotNull()).groupBy("token").agg(F.sum("docs").alias("docs")).orderBy(F.desc("docs"), "token").limit(FREQUENT)
    frequent = np.sort(often.select("token").toArrow().column("token").to_numpy().astype(np.uint64))

    usable = docs.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    sets = written(usable.groupBy("n", "one", "two").agg(F.min("doc_id").alias("set_id"), F.count(F.lit(1)).alias("weight")), "ngram-sets")
    size = sets.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("members"), F.coalesce(F.max("n"), F.lit(1)).alias("largest")).first()
    levels = Levels(percent, size["largest"])

    # Rows whose set another document represents.
    copies = written(share_join(usable, sets, ["n", "one", "two"], size["rows"]).filter(F.col("doc_id") != F.col("set_id")).select("doc_id", "text_hash").distinct(), "ngram-copies")
    apart = source.filter(F.col("doc_id").isNotNull()).join(small(copies), ["doc_id", "text_hash"], "left_anti")

    buckets = max(1, -(-size["members"] * 3 // 10 // TASK_SIGNATURES))
    dealt = apart.select("doc_id", "text").mapInArrow(_deal(words, frequent, levels, buckets), "bucket long, signatures binary, owners binary")
    met = components(dealt.groupBy("bucket").applyInArrow(_meet, "a long, b long"))
    blocks = met.withColumnRenamed("component", "block")

    # Members by block decide how a block is dealt.
    sized = blocks.join(sets.select(F.col("set_id").alias("node"), "n"), "node").groupBy("block").agg(F.sum("n").alias("members"))
    chunks = sized.select("block", F.greatest(F.lit(1), F.ceil(F.col("members") * 2 / block_members)).cast("long").alias("chunks"), "members")
    chunks = written(chunks.withColumn("chunks", F.when(F.col("members") <= block_members, F.lit(1).cast("long")).otherwise(F.col("chunks"))), "ngram-chunks")
    # Small blocks share places: as many as the cluster has partitions, or more where members ask for it.
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(chunks.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]) // TASK_MEMBERS))
    routed = written(blocks.join(chunks.drop("members"), "block").select(F.col("node").alias("doc_id"), "block", "chunks"), "ngram-routes")

    candidates = apart.join(small(routed), "doc_id").select("doc_id", "block", "chunks", "text")
    candidates = candidates.mapInArrow(_members(words), "doc_id long, block long, chunks long, members binary")
    chunk = F.pmod(F.xxhash64("doc_id"), F.col("chunks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    candidates = candidates.withColumn("chunk", chunk).withColumn("other", other)
    one = F.col("chunks") == 1
    candidates = candidates.select(
        "doc_id",
        "block",
        "members",
        F.when(one, F.pmod(F.xxhash64("block"), F.lit(tasks))).otherwise(F.col("block")).alias("place"),
        F.when(one, F.lit(-1).cast("long")).otherwise(F.least("chunk", "other")).alias("left"),
        F.when(one, F.lit(-1).cast("long")).otherwise(F.greatest("chunk", "other")).alias("right"),
    )
    links = candidates.groupBy("place", "left", "right").applyInArrow(_owner(percent), "a long, b long")
    reached = components(links)
    discard(copies, met, chunks, routed)

    found = share_join(docs, sets, ["n", "one", "two"], size["rows"], "left").join(reached.withColumnRenamed("node", "set_id"), "set_id", "left")
    named = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.col("component"), F.col("set_id"), F.col("doc_id")))
    found = found.select("doc_id", F.col("n").alias("n_shingles"), named.alias("component_id"), F.when(F.col("doc_id").isNotNull(), F.coalesce(F.col("set_id"), F.col("doc_id"))).alias("set_id"))
    found.reads = (described, sets, reached)
    return found


def one_of_each(df: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """df with the document of the smallest doc_id of each near-duplicate group; columns unchanged.

    Only ids of the others meet the table again. Rows with a null doc_id stay.
    """
    found = near_duplicates(df, words, percent, key, text)
    others = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__id")).distinct()
    others = written(others, "ngram-others")
    discard(*found.reads)
    return df.join(small(others), F.col(key) == F.col("__id"), "left_anti")
