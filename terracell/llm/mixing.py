"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

Targets follow from one row per source (water filling). Each document has a
30-bit hash of its id; a source's documents below its threshold are taken once
more than the others. The threshold is found without sorting: sizes are summed
by source and hash bucket, the bucket in which the running total passes the
budget is the boundary, and only its documents are summed again by the next
bits of the hash. Thresholds are nested: a larger budget keeps all that a
smaller one took.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracell.llm.shared import WORD, discard, text_or_empty, written

#: Bits of the hash for each level of the histogram; together 30.
LEVELS = (10, 10, 10)
BITS = sum(LEVELS)
#: Weights by rank of source, repeating; what the mix takes of all sizes; times that a document may be taken.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2


def place(key: Column) -> Column:
    """A document's 30-bit hash: the first bits of the MD5 of its id as text; null counts as an empty text."""
    first = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long")
    return F.shiftright(first, 32 - BITS)


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources rank by code point, null last; weights repeat along the ranks.
    Targets share ``share`` of all sizes by weight; those above ``most`` times
    their source stop there and the excess goes to the rest by weight until
    none is above. Filling by weight up to caps is filling water: sources are
    ranked by cap over weight, the first k are full, and the level of the rest
    is what is left over their weights, for the smallest k at which it fits.
    Beyond that k the level only falls, so it is the largest that fits.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.select("source", "source_size", weight.alias("weight"))
    rows = rows.withColumn("cap", F.col("source_size").cast("double") * most).withColumn("height", F.col("cap") / F.col("weight"))
    upto = Window.orderBy("height", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns(
        {
            "full": F.coalesce(F.sum("cap").over(upto), F.lit(0.0)),
            "left": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)),
            "budget": F.sum(F.col("source_size")).over(whole).cast("double") * share,
        }
    )
    level = F.when(F.col("left") > 0, (F.col("budget") - F.col("full")) / F.col("left"))
    rows = rows.withColumn("level", F.when(level <= F.col("height"), level)).withColumn("level", F.max("level").over(whole))
    return rows.select("source", "source_size", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight"))).alias("target"))


def thresholds(narrow: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, threshold) from (source, place, size) and the targets, a written table that goes.

    ``whole`` is how often every document of the source is taken; those with a
    place below ``threshold`` are taken once more. The threshold is the cell
    edge nearest the budget, at the finest level of the hash.
    """
    budget = F.when(F.col("source_size") > 0, F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size")).otherwise(0.0)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.select("source", "source_size", "target", whole.cast("int").alias("whole"), budget.alias("rest"), F.lit(0).cast("long").alias("prefix"))
    done = 0
    for n, bits in enumerate(LEVELS):
        done += bits
        cells = narrow.select(F.col("source").alias("of"), F.shiftright("place", BITS - done).alias("cell"), "size")
        if n:
            inside = state.select(F.col("source").alias("at"), F.col("prefix").alias("edge"))
            cells = cells.join(inside, F.col("of").eqNullSafe(F.col("at")) & (F.shiftright("cell", bits) == F.col("edge")), "left_semi")
        sums = cells.groupBy("of", "cell").agg(F.sum("size").cast("double").alias("size"))
        running = Window.partitionBy("of").orderBy("cell")
        sums = sums.withColumn("upto", F.sum("size").over(running))
        joined = state.join(sums, F.col("source").eqNullSafe(F.col("of")), "left")
        passed = F.col("upto") > F.col("rest")
        last = n == len(LEVELS) - 1
        edge = F.min(F.when(passed, F.struct("cell", (F.col("upto") - F.col("size")).alias("below"), "size")))
        joined = joined.groupBy("source", "source_size", "target", "whole", "rest", "prefix").agg(edge.alias("edge"))
        rest = F.col("rest") - F.coalesce(F.col("edge.below"), F.lit(0.0))
        cell = F.coalesce(F.col("edge.cell"), F.shiftleft(F.col("prefix") + 1, bits))
        if last:
            cell = cell + F.when(F.col("edge").isNotNull() & (rest * 2 > F.col("edge.size")), 1).otherwise(0)
        before, state = state, written(joined.select("source", "source_size", "target", "whole", rest.alias("rest"), cell.alias("prefix")), f"mix-level{n}")
        discard(*([before] if n else [targets]))
    return state.select("source", "source_size", "target", "whole", F.col("prefix").alias("threshold"))


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One narrow row for each row of df: doc_id, size, source, source_size, target, taken, times.

    Sizes are words; a null or empty text has none and is never taken more
    than it weighs (taken 0). A null source is a source of its own and ranks
    last. Rows with one doc_id share a hash, so they are taken alike. An empty
    table gives an empty one. Other columns are ignored. Reruns agree: all
    follows from the rows.
    """
    narrow = df.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long").alias("size"), place(F.col(key)).alias("place"))
    narrow = written(narrow, "mix-rows")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes, weights, share, most), "mix-targets")
    found = thresholds(narrow, targets).withColumnRenamed("source", "of")
    rows = narrow.join(found, F.col("source").eqNullSafe(F.col("of")), "left")
    times = F.col("whole") + F.when(F.col("place") < F.col("threshold"), 1).otherwise(0)
    return rows.select("doc_id", "size", "source", "source_size", "target", (F.col("size") * times).alias("taken"), times.cast("int").alias("times"))


def mixed_rows(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **kw) -> DataFrame:
    """The mixed corpus itself: each row of df as often as the mix takes it (0 to ``most`` times), columns unchanged.

    The decision is a function of the row and its source's threshold, so no
    text travels: the thresholds, one row per source, join the rows.
    """
    narrow = written(df.select(F.col(source).cast("string").alias("source"), F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long").alias("size"), place(F.col(key)).alias("place")), "mix-rows")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes, **kw), "mix-targets")
    found = thresholds(narrow, targets).select(F.col("source").alias("__of"), F.col("whole").alias("__whole"), F.col("threshold").alias("__threshold"))
    discard(narrow)
    rows = df.join(found, F.col(source).cast("string").eqNullSafe(F.col("__of")), "left")
    times = F.col("__whole") + F.when(place(F.col(key)) < F.col("__threshold"), 1).otherwise(0)
    return rows.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(*df.columns)


def _level_sql(n: int) -> str:
    return f"""
state{n + 1} AS (
  SELECT s.source, s.source_size, s.target, s.whole, s.rest - coalesce(e.below, 0) AS rest,
    coalesce(e.cell, (s.prefix + 1) * {1 << LEVELS[n]}) {"+ CASE WHEN e.cell IS NOT NULL AND (s.rest - e.below) * 2 > e.size THEN 1 ELSE 0 END" if n == len(LEVELS) - 1 else ""} AS prefix
  FROM state{n} s LEFT JOIN (
    SELECT s.source, c.cell, c.upto - c.size AS below, c.size,
      row_number() OVER (PARTITION BY s.source ORDER BY c.cell) AS nth
    FROM state{n} s JOIN (
      SELECT source, cell, size, sum(size) OVER (PARTITION BY source ORDER BY cell) AS upto FROM (
        SELECT d.source, d.place >> {BITS - sum(LEVELS[: n + 1])} AS cell, sum(d.size)::DOUBLE AS size
        FROM docs d JOIN state{n} s ON d.source IS NOT DISTINCT FROM s.source AND (d.place >> {BITS - sum(LEVELS[:n])}) = s.prefix
        GROUP BY 1, 2)) c ON s.source IS NOT DISTINCT FROM c.source AND c.upto > s.rest) e
  ON s.source IS NOT DISTINCT FROM e.source AND e.nth = 1)"""


#: The same mix in DuckDB SQL.
SQL = f"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    (('0x' || substring(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT) >> {32 - BITS} AS place
  FROM documents),
named AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS nth FROM docs GROUP BY source),
weighed AS (SELECT source, source_size, CASE (nth - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight, {MOST}.0::DOUBLE * source_size AS cap FROM named),
ranked AS (
  SELECT *, cap / weight AS height,
    coalesce(sum(cap) OVER w, 0) AS filled, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS remaining,
    sum(source_size) OVER ()::DOUBLE * {SHARE} AS budget
  FROM weighed WINDOW w AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max((budget - filled) / remaining) AS level FROM ranked WHERE remaining > 0 AND (budget - filled) / remaining <= height),
targets AS (SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * weight) END AS target FROM ranked, level),
state0 AS (
  SELECT source, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
    CASE WHEN source_size > 0 THEN target - floor(target / source_size) * source_size ELSE 0 END AS rest, 0::BIGINT AS prefix
  FROM targets),{",".join(_level_sql(n) for n in range(len(LEVELS)))}
SELECT d.doc_id, d.size, s.source_size, s.target, (d.size * (s.whole + CASE WHEN d.place < s.prefix THEN 1 ELSE 0 END))::BIGINT AS taken
FROM docs d JOIN state{len(LEVELS)} s ON d.source IS NOT DISTINCT FROM s.source
"""
