"""Mixing sources to target weights, in DataFrame operations only.

Words are summed for each source, the mix is divided by weight (water filling:
a source whose cap is reached hands its excess to the others), and each document
is taken floor(rate) times plus once more if a hash of its id, source and text falls
below the rate's fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, staged

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
#: Sources up to which their table is broadcast (about 100 bytes each).
BROADCAST_SOURCES = 50_000
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = 1.0, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size long, target double) from (source, size).

    Sources in code point order, nulls last, take ``weights`` in turn and share
    ``share`` of all words. A target stops at ``max_rate`` times the source's
    size; the excess goes to the others by weight until none is above. The window
    below runs over one row for each source, never over documents.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (turn % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_rate)
    # Sources fill up in the order of cap / weight. With those before it full, a
    # source is full too if its part of the rest is more than its cap.
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("source_size").over(everything)
    if share != 1.0:
        total = F.floor(total * share)
    rest = total - F.coalesce(F.sum("cap").over(before), F.lit(0))
    filled = ranked.select(
        "source", "source_size", "weight", "cap", rest.alias("rest"), F.sum("weight").over(onward).alias("open_weight"))
    full = F.col("rest") / F.col("open_weight") >= F.col("cap") / F.col("weight")
    # The first source that is not full fixes the level for all that follow.
    level = F.first(F.when(~full, F.struct("rest", "open_weight")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.least(
        (F.col("level.rest") * F.col("weight")).cast("double") / F.col("level.open_weight").cast("double"),
        F.col("cap").cast("double")))
    return filled.withColumn("level", level).select("source", "source_size", target.alias("target"))


def draw(*keys: Column, seed: int = 11) -> Column:
    """A number in [0, 1) from a hash of the keys: the same in every run."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def with_copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                weights: tuple = WEIGHTS, share: float = 1.0, max_rate: int = MAX_RATE, seed: int = 11) -> DataFrame:
    """Every row of ``docs`` (all columns) with size, source_size, target and copies.

    copies = floor(rate) + (draw < fraction) with rate = target / source_size, so
    none exceeds ``max_rate``. Null texts have size 0, null sources are a source
    of their own; rows with one id, or none, draw apart unless source and text are equal
    too. A source without words has rate 0. An empty table gives no rows.
    """
    names = {c: fresh(docs.columns, c) for c in ("size", "source_size", "target", "copies")}
    size, key = names["size"], fresh(docs.columns, "mixed_source")
    sized = docs.withColumn(size, word_count(F.col(text_col)))
    targets = staged(source_targets(sized.select(F.col(source_col).alias("source"), F.col(size).alias("size")),
                                    weights, share, max_rate), "source_targets")
    few = targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    targets = targets.select(F.col("source").alias(key), F.col("source_size").alias(names["source_size"]),
                             F.col("target").alias(names["target"]))
    joined = sized.join(F.broadcast(targets) if few else targets, F.col(source_col).eqNullSafe(F.col(key)))
    rate = F.coalesce(F.col(names["target"]) / F.nullif(F.col(names["source_size"]), F.lit(0)), F.lit(0.0))
    extra = F.when(draw(F.col(id_col), F.col(source_col), F.md5(F.col(text_col).cast("string").cast("binary")), seed=seed) < rate - F.floor(rate), 1).otherwise(0)
    return joined.withColumn(names["copies"], (F.floor(rate) + extra).cast("int")).drop(key)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with copy (int from 1)."""
    out = with_copies(docs, **options)
    copies, copy = out.columns[-1], fresh(docs.columns, "copy")
    return out.where(F.col(copies) > 0).select(
        *docs.columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copy))


def mixing_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words taken, repeats counted) of every row."""
    out = with_copies(docs.select("doc_id", "source", "text"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


#: DuckDB SQL for the rows of ``mixing_report``.
MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(text) AS digest, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, source_size * 3 AS cap, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
    WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS weight FROM sources),
filled AS (
  SELECT *, (SELECT sum(source_size) FROM sources)::BIGINT - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
    (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS open_weight FROM weighted),
level AS (
  SELECT rest, open_weight, cap::DOUBLE / weight AS level_at FROM filled WHERE NOT (rest::DOUBLE / open_weight >= cap::DOUBLE / weight)
  ORDER BY level_at, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN f.cap::DOUBLE / f.weight >= l.level_at AND NOT (f.rest::DOUBLE / f.open_weight >= f.cap::DOUBLE / f.weight)
      THEN least((l.rest * f.weight)::DOUBLE / l.open_weight::DOUBLE, f.cap::DOUBLE) ELSE f.cap::DOUBLE END AS target
  FROM filled f LEFT JOIN level l ON true),
rated AS (
  SELECT doc_id, sized.source, digest, size, source_size, target, coalesce(target / nullif(source_size, 0), 0.0) AS rate
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target, size * (floor(rate) + CASE
    WHEN ('0x' || substr(md5(concat_ws('|', '11', doc_id::VARCHAR, source, digest)), 1, 12))::BIGINT::DOUBLE / 281474976710656.0
      < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM rated
"""
