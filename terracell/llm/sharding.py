"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in Column expressions only.

The jump function needs 64-bit wrap-around multiplication, which ANSI
arithmetic refuses, so the generator's state is kept as two 32-bit halves and
multiplied by limbs. Nothing is looked up: a row's shard follows from its key
and the number of shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracell.llm.shared import text_or_empty, written

#: The multiplier of the published generator.
MULTIPLIER = 2862933555777941757
LOW32 = 0xFFFFFFFF
LOW16 = 0xFFFF
#: Jumps are about ln(shards); beyond so many steps a second, rarely evaluated fold goes on.
FIRST_STEPS = 64
#: Rows numbered together, on average; the number of buckets follows the table.
ROWS_PER_BUCKET = 50_000
#: Equal rows are copied out in runs of this length.
RUN = 4096


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """(high, low) of state * MULTIPLIER + 1 modulo 2**64; all four are longs from 0 to 2**32 - 1."""
    m_high, m_low = MULTIPLIER >> 32, MULTIPLIER & LOW32
    part = F.shiftright(low, 16) * F.lit(m_low)
    total = low.bitwiseAND(F.lit(LOW16)) * F.lit(m_low) + F.shiftleft(part.bitwiseAND(F.lit(LOW16)), 16) + F.lit(1)
    high_part = F.shiftright(high, 16) * F.lit(m_low)
    crossed = (
        high.bitwiseAND(F.lit(LOW16)) * F.lit(m_low)
        + F.shiftleft(high_part.bitwiseAND(F.lit(LOW16)), 16)
        + (low * F.lit(m_high)).bitwiseAND(F.lit(LOW32))
        + F.shiftright(part, 16)
        + F.shiftright(total, 32)
    )
    return crossed.bitwiseAND(F.lit(LOW32)), total.bitwiseAND(F.lit(LOW32))


def _halves(key: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(key, 32), key.bitwiseAND(F.lit(LOW32))


def key_long(df: DataFrame, name: str) -> Column:
    """The 64-bit key of a column: integers as they are, other types by xxhash64; null counts as 0."""
    kind = df.schema[name].dataType
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return F.coalesce(F.col(name).cast("long") if whole else F.xxhash64(F.col(name)), F.lit(0).cast("long"))


def jump(key: Column, shards: int) -> Column:
    """struct(shard, beyond): the shard, and the first jump target at or beyond ``shards``.

    With one shard more, the row goes to the new shard exactly if
    ``beyond = shards``; else it stays.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")

    def step(state: Column, _: Column) -> Column:
        high, low = _next_state(state["high"], state["low"])
        beyond = F.floor((state["beyond"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double")))
        went_on = F.struct(high.alias("high"), low.alias("low"), state["beyond"].alias("shard"), beyond.cast("long").alias("beyond"))
        return F.when(state["beyond"] >= shards, state).otherwise(went_on)

    high, low = _halves(key)
    zero = F.lit(0).cast("long")
    start = F.struct(high.alias("high"), low.alias("low"), zero.alias("shard"), zero.alias("beyond"))
    state = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, FIRST_STEPS))), start, step)
    if shards > FIRST_STEPS:
        rest = F.aggregate(F.sequence(F.lit(1), F.lit(shards - FIRST_STEPS)), state, step)
        state = F.when(state["beyond"] >= shards, state).otherwise(rest)
    return F.struct(state["shard"].cast("int").alias("shard"), state["beyond"].alias("beyond"))


def assign_shards(df: DataFrame, key: str, shards: int) -> DataFrame:
    """df with ``shard`` (0 to shards - 1) and ``grown_shard`` (with one shard more); no shuffle.

    A null key counts as 0. Columns of these two names in df are replaced.
    Repeated rows go to the same shard; an empty table gives an empty one.
    """
    jumped = df.withColumn("shard", jump(key_long(df, key), shards))
    return jumped.withColumn("grown_shard", F.when(F.col("shard.beyond") == shards, F.lit(shards)).otherwise(F.col("shard.shard")).cast("int")).withColumn("shard", F.col("shard.shard"))


def shard_slots(df: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One narrow row for each row of df: key, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 8; a null text has no bytes, so its
    size is 8 and its checksum 0. Slots number each shard's rows from 0
    without gaps, ordered by a mixed value of key and checksum. The numbering
    never sorts a shard in one task: shards are cut into buckets of that mixed
    value, only bucket totals are summed over a shard, and equal rows are
    combined before the shuffle, so hot keys, hot texts and repeated rows
    spread or shrink.
    """
    spread = 1 << 31
    narrow = df.select(F.col(key).alias("doc_id"), (F.octet_length(text_or_empty(text)) + 8).cast("long").alias("size"), F.crc32(text_or_empty(text).cast("binary")).alias("text_crc32"))
    rows = narrow.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    rows = assign_shards(rows, "doc_id", shards)
    first_high, _ = _next_state(*_halves(key_long(rows, "doc_id")))
    rows = written(rows.withColumn("place", (F.shiftright(first_high, 1) + F.col("text_crc32")) % spread), "shards")
    buckets = max(1, -(-rows.count() // ROWS_PER_BUCKET))
    rows = rows.withColumn("bucket", F.floor(F.col("place") * buckets / spread).cast("long") if buckets < 1 << 31 else F.col("place"))

    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("shard", "bucket").agg(F.sum("copies").alias("in_bucket"))
    totals = totals.select("shard", "bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "bucket").orderBy("place", "doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("copies").over(within), F.lit(0))).join(totals, ["shard", "bucket"])
    runs = placed.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(RUN).cast("long"))))
    each = runs.withColumn("copy", F.explode(F.sequence(F.col("run"), F.least(F.col("run") + RUN, F.col("copies")) - 1)))
    return each.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("inside") + F.col("copy")).alias("slot"), "grown_shard")
