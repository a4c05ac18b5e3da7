"""Exact deduplication over an extendible-hash index, in DataFrame operations only.

Every text is normalised and hashed once. The directory of the index has one
cell for each prefix of the hash; cells point to buckets. While a bucket holds
more entries than it may, it splits by the next bit of its hashes, and where
its prefix is as long as the directory's, the directory doubles. Contiguous
runs of buckets belong to owners, so an owner is a range of hashes. Its task
gets the entries of its range, chains those of one hash in the order of their
bytes, compares each with the one before it, and so finds the smallest id and
the number of rows of each text. All decisions come from these chains.

A hash that one row has needs no bytes: its entry travels without the text.
Equal texts combine before they travel to their owner, in a few salted parts,
so a text that a third of all rows share is a handful of entries there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracell.llm.shared import BROADCAST_ROWS, SPACE, discard, share_join, small, text_or_empty, written

#: Distinct hashes that a bucket holds before it is split.
BUCKET_ENTRIES = 4_096
#: The largest directory: 2 ** MAX_DEPTH cells, which bounds its broadcast. Its buckets may hold more than they should; they are still exact.
MAX_DEPTH = 20
#: Text that an owner's task reads, about; there are as many owners as shuffle partitions at least.
OWNER_BYTES = 256 << 20
#: Parts in which equal texts combine.
SALTS = 8
#: Hashes of more than this share of all rows combine wherever they are; there are at most as many.
HOT_SHARE = 100_000
#: Equal rows are copied out in runs of this length.
RUN = 4096


def normalised(name: str = "text") -> Column:
    """The text with each run of ASCII white space made one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(name), SPACE, " ")


def _cell(hashed: Column, depth: int) -> Column:
    """The first ``depth`` bits of the hash, as a number from 0."""
    return F.shiftright(F.shiftrightunsigned(hashed, 64 - MAX_DEPTH), MAX_DEPTH - depth)


def directory(hashes: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """The directory's buckets (depth, cell, entries): split by prefix until none is overfull.

    hashes has one row for each distinct ``hash``. Counts per finest cell are
    summed once. The directory starts at the depth that even hashes would
    fill twice over; each doubling then only looks at the children of overfull
    buckets. An empty table gives an empty directory.
    """
    fine = written(hashes.groupBy(_cell(F.col("hash"), MAX_DEPTH).alias("fine")).agg(F.count(F.lit(1)).alias("entries")), "dedup-cells")
    total = fine.agg(F.coalesce(F.sum("entries"), F.lit(0))).first()[0]
    depth = min(MAX_DEPTH, max(0, (total // (2 * bucket_entries)).bit_length() - 1))
    found, open_cells, used = None, None, [fine]
    while True:
        level = fine.withColumn("cell", F.shiftright(F.col("fine"), MAX_DEPTH - depth))
        if open_cells is not None:
            level = level.join(small(open_cells.select(F.col("cell").alias("parent"))), F.shiftright(F.col("cell"), 1) == F.col("parent"), "left_semi")
        level = written(level.groupBy("cell").agg(F.sum("entries").alias("entries")), f"dedup-depth{depth}")
        used.append(level)
        full = F.col("entries") > bucket_entries
        done = level if depth == MAX_DEPTH else level.filter(~full)
        done = done.select(F.lit(depth).alias("depth"), "cell", "entries")
        found = done if found is None else found.unionByName(done)
        open_cells = level.filter(full)
        if depth == MAX_DEPTH or open_cells.isEmpty():
            found = written(found, "dedup-directory")
            discard(*used)
            return found
        depth += 1


def owners(buckets: DataFrame, count: int) -> tuple[DataFrame, int]:
    """((cell, owner) for every cell of the whole directory, its depth): owners are runs of buckets with about as many entries each."""
    depth = buckets.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    first = F.expr(f"shiftleft(cell, {depth} - depth)")
    in_order = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)  # at most 2 ** MAX_DEPTH buckets
    total = buckets.agg(F.coalesce(F.sum("entries"), F.lit(1))).first()[0]
    owned = buckets.withColumn("first", first).withColumn("owner", F.floor(F.coalesce(F.sum("entries").over(in_order), F.lit(0)) * count / F.lit(max(1, total))).cast("int"))
    step = F.expr(f"shiftleft(1L, {depth} - depth)")
    cells = owned.select("owner", F.explode(F.sequence(F.col("first"), F.col("first") + step - 1)).alias("cell"))
    return cells, depth


def _index(hashed: DataFrame, hashes: DataFrame, bucket_entries: int) -> tuple[DataFrame, int]:
    """((hash, text_sha256, keep_id, group_size, weight) of each text, from its owner's chain, number of rows).

    There is no digest where no other row has the hash; weight is the rows of
    the whole chain.
    """
    size = hashes.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count(F.when(F.col("rows") > 1, 1)).alias("shared"),
        F.coalesce(F.sum(F.when(F.col("rows") > 1, F.col("bytes")).otherwise(24)), F.lit(0)).alias("bytes"),
    ).first()
    session = hashed.sparkSession
    count = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-size["bytes"] // OWNER_BYTES))
    buckets = directory(hashes.select("hash"), bucket_entries)
    cells, depth = owners(buckets, count)
    cells = written(cells, "dedup-cells-owned")

    def combined(rows: DataFrame) -> DataFrame:
        salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        return salted.groupBy("hash", "body", "salt").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("rows")).drop("salt")

    if size["shared"] <= BROADCAST_ROWS:
        # Few hashes are shared: only their texts travel.
        texts = hashed.join(F.broadcast(hashes.filter(F.col("rows") > 1).select("hash")), "hash", "left_semi")
        alone = hashes.filter(F.col("rows") == 1).select("hash", F.lit(None).cast("string").alias("body"), "keep_id", "rows")
        entries = combined(texts).unionByName(alone)
    else:
        # Texts go to their owners without a join; frequent ones, at most HOT_SHARE of them, combine first.
        hot = F.broadcast(hashes.filter(F.col("rows") * HOT_SHARE > size["rows"]).select("hash"))
        cold = hashed.join(hot, "hash", "left_anti").select("hash", "body", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("rows"))
        entries = combined(hashed.join(hot, "hash", "left_semi")).unionByName(cold)

    dealt = entries.withColumn("cell", _cell(F.col("hash"), depth)).join(F.broadcast(cells), "cell").repartition(count, "owner")
    chain = Window.partitionBy("owner", "hash").orderBy("body")
    chained = dealt.withColumn("fresh", F.when(F.lag("body").over(chain).eqNullSafe(F.col("body")), 0).otherwise(1))
    chained = chained.withColumn("place", F.sum("fresh").over(chain.rowsBetween(Window.unboundedPreceding, 0)))
    texts = chained.withColumn("text_sha256", F.sha2(F.col("body").cast("binary"), 256)).groupBy("owner", "hash", "place")
    texts = texts.agg(F.max("text_sha256").alias("text_sha256"), F.min("keep_id").alias("keep_id"), F.sum("rows").alias("group_size"))
    # Both hashes equal, bytes different: never merged silently.
    texts = texts.groupBy("owner", "hash", "text_sha256").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    sure = F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share both hashes")).cast("long"))
    chain_rows = F.sum("group_size").over(Window.partitionBy("owner", "hash"))
    index = written(texts.select("hash", "text_sha256", "keep_id", sure.alias("group_size"), chain_rows.alias("weight")), "dedup-index")
    discard(buckets, cells)
    return index, size["rows"]


def dedup_decisions(df: DataFrame, key: str = "doc_id", text: str = "text", bucket_entries: int = BUCKET_ENTRIES, fingerprint: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One narrow row for each row of df: doc_id, keep_id, group_size, kept, text_sha256, copy.

    Texts are equal when identical after normalisation; null and empty texts
    are equal to each other. The smallest doc_id of a group stays; a null
    doc_id stays only where its group has no other. Of repeated rows with the
    same doc_id and text just one (copy 0) is kept. Other columns are ignored;
    an empty table gives an empty one. ``fingerprint`` is the index's hash
    (long); collisions cost time, not correctness.
    """
    source = df.select(F.col(key).alias("doc_id"), normalised(text).alias("body"))
    hashed = source.withColumn("hash", fingerprint(F.col("body")))
    rows = hashed.withColumn("text_sha256", F.sha2(F.col("body").cast("binary"), 256)).groupBy("doc_id", "hash", "text_sha256")
    rows = written(rows.agg(F.count(F.lit(1)).alias("copies"), F.max(F.octet_length("body")).alias("bytes")), "dedup-rows")
    hashes = written(rows.groupBy("hash").agg(F.sum("copies").alias("rows"), F.min("doc_id").alias("keep_id"), F.max("bytes").cast("long").alias("bytes")), "dedup-hashes")
    index, total = _index(hashed, hashes, bucket_entries)
    discard(hashes)

    entries = index.withColumnRenamed("text_sha256", "chained_sha")
    judged = share_join(rows.drop("bytes"), entries, ["hash"], total).filter(F.col("chained_sha").isNull() | (F.col("chained_sha") == F.col("text_sha256")))
    runs = judged.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(RUN).cast("long"))))
    each = runs.withColumn("copy", F.explode(F.sequence(F.col("run"), F.least(F.col("run") + RUN, F.col("copies")) - 1)))
    found = each.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"),
        "text_sha256",
        "copy",
    )
    found.reads = (rows, index)
    return found


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """df without the rows that exact deduplication drops; columns unchanged.

    Only the decisions that drop a row meet the table again, by id and hash of
    the normalised text. Repeated rows, if there are any, shrink to one.
    """
    decisions = dedup_decisions(df, key, text)
    judged = written(decisions, "dedup-judged")
    discard(*decisions.reads)
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))

    def named(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()

    dropped = written(named(judged.filter(~stays)), "dedup-dropped")
    repeated = written(named(judged.filter(stays & (F.col("copy") > 0))), "dedup-repeated")
    discard(judged)
    rows = df.withColumn("__text", F.sha2(normalised(text).cast("binary"), 256))
    meets = F.col(key).eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__sha"))
    rows = rows.join(small(dropped), meets, "left_anti")
    if not repeated.isEmpty():
        single = rows.join(small(repeated), meets, "left_semi").dropDuplicates([key, "__text"])
        rows = rows.join(small(repeated), meets, "left_anti").unionByName(single)
    return rows.select(*df.columns)
