"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import WORD
from rowloom.plans.scratch import materialize

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Documents of a source that are ordered together; a source of any size is cut into such groups.
GROUP_ROWS = 256
#: A document is long if it has more words than so many average documents of its source.
LONG = 16


def lots(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A seeded order: MD5 of seed, id and the text's MD5, the same in every run and engine.

    Rows that share an id, null included, get lots of their own unless their texts are equal too.
    """
    own = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return F.md5(F.concat(
        F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), own
    ).cast("binary"))


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, lot``: words of each text (null: 0) and the seeded lot of the row."""
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)).cast("long"), F.lit(0)).alias("size"),
        lots(F.col("doc_id"), F.col("text")).alias("lot"),
    )


def targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """``source, source_size, n_docs, target``, one row per source.

    Water-filling in closed form.  With sources in the order of cap / weight,
    filling the first k to their caps leaves the level (total - caps) / weights
    of the rest; the true level is the highest of these.  Windows here run over
    one row per source, after the documents were summed map-side.
    """
    per_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    position = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = per_source.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), position + 1).cast("long")
    ).withColumn("cap", F.col("source_size") * max_epochs)
    first_full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = first_full.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    return (
        weighted.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .select(
            "source", "source_size", "n_docs",
            F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"),
        )
    )


def _fraction(lot: Column, start: int) -> Column:
    """Twelve hexadecimal digits of a lot as a number from 0 to 1."""
    return F.conv(F.substring(lot, start, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """``doc_id, source, size, lot, source_size, target, repeats, extra, taken`` for each row.

    A source's rate is target / size.  Every document is taken whole ``repeats``
    = floor(rate) times.  The fraction left is sampled in whole documents; ``extra`` is
    0 or 1.  Long documents are each drawn with the fraction as probability.  What
    they give too much or too little is known from one sum per source and is made up
    by the others, whose fraction changes accordingly.  Those lie in seeded order in groups of
    about ``GROUP_ROWS``: a group gives its first documents while its share
    of words is not exceeded, then the one of the others whose size is nearest to what is
    missing, if that brings it closer.  No group grows with a source.

    Null text: size 0.  Null source: a source of its own, last in order.  Null
    or repeated ids: rows are told apart by their texts; rows equal in id, source and text
    are interchangeable and stay in one group.  Empty table: no rows.
    """
    sized = materialize(sizes(docs), "mix-sizes")
    # Rows of sources are written, so that Spark knows their size: a small table is sent to all, only a large one is joined by key.
    plan = materialize(
        targets(sized, weights, max_epochs).select(F.col("source").alias("_source"), "source_size", "n_docs", "target"),
        "mix-targets",
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("_source"))).select(
        "_source", "doc_id", "source", "size", "lot", "source_size", "n_docs", "target",
        F.floor(rate).alias("repeats"), (rate - F.floor(rate)).alias("part"),
        (F.col("size") * F.col("n_docs") > LONG * F.col("source_size")).alias("long"),
    ).withColumn("drawn", F.col("long") & (_fraction(F.col("lot"), 13) < F.col("part")))
    others = materialize(joined.groupBy(F.col("_source").alias("_of")).agg(
        F.sum(F.when(F.col("drawn"), F.col("size")).otherwise(0)).alias("drawn_size"),
        F.sum(F.when(F.col("long"), 0).otherwise(F.col("size"))).alias("other_size"),
    ), "mix-drawn")
    missing = F.col("part") * F.col("source_size") - F.col("drawn_size")
    share_of_others = F.when(
        F.col("other_size") > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), missing / F.col("other_size")))
    ).otherwise(0.0)
    group = F.when(F.col("long"), -1).otherwise(
        F.conv(F.substring("lot", 1, 12), 16, 10).cast("long") % F.ceil(F.col("n_docs") / GROUP_ROWS)
    )
    met = joined.join(others, F.col("source").eqNullSafe(F.col("_of")))
    placed = met.select("*", group.alias("group"), share_of_others.alias("fraction"))
    columns = ("doc_id", "source", "size", "lot", "source_size", "target", "repeats")
    seeded = placed.where("NOT long")
    keys = ("source", "group")
    every = Window.partitionBy(*keys)
    order = every.orderBy("lot", F.col("doc_id").asc_nulls_first(), "size")
    share = F.floor(F.col("fraction") * F.sum("size").over(every) + 0.5)
    seeded = seeded.select(
        *columns, *keys[1:], F.row_number().over(order).alias("place"), share.alias("share"),
        F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("end"),
    ).withColumn("first", F.col("end") <= F.col("share"))
    gap = F.col("share") - F.max(F.when(F.col("first"), F.col("end")).otherwise(0)).over(every)
    seeded = seeded.withColumn("gap", gap).withColumn("off", F.abs(F.col("size") - F.col("gap")))
    nearest = F.min(F.when(~F.col("first"), F.struct("off", "place"))).over(every)
    filler = ~F.col("first") & (F.col("off") < F.col("gap")) & (nearest == F.struct("off", "place"))
    chosen = seeded.select(*columns, (F.col("first") | filler).cast("int").alias("extra")).unionByName(
        placed.where("long").select(*columns, F.col("drawn").cast("int").alias("extra"))
    )
    taken = (F.col("repeats") + F.col("extra")) * F.col("size")
    return chosen.withColumn("taken", taken)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each whole and as often as it is taken.  Columns are those of ``docs``."""
    plan = mix(docs).where("taken > 0").select(
        F.col("lot").alias("_lot"), F.col("source").alias("_of"), (F.col("repeats") + F.col("extra")).alias("_copies"),
    )
    # Rows with the same lot and source have the same id and text; they are paired one to one by rank.
    rank = lambda order: F.row_number().over(Window.partitionBy("_lot", "_of").orderBy(order))
    keyed = docs.select(
        "*", lots(F.col("doc_id"), F.col("text")).alias("_lot"), F.col("source").cast("string").alias("_of")
    )
    keyed = keyed.select("*", rank("_lot").alias("_rank")).alias("d")
    plan = plan.select("*", rank(F.col("_copies").desc()).alias("_rank")).alias("p")
    met = keyed.join(plan, [F.col(f"d.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("_lot", "_of", "_rank")])
    rows = met.select(
        *[F.col(f"d.{c}") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")
    )
    return rows.select(*docs.columns)


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS lot,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, source_size * 3 AS cap,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM per_source),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM weighted WINDOW before AS (
    ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
plan AS (
  SELECT source, source_size, n_docs,
         least(CAST(cap AS DOUBLE), max(level) OVER () * weight) AS target
  FROM levels),
rated AS (
  SELECT d.doc_id, d.source, d.lot, d.size, p.source_size, p.n_docs, p.target,
         CASE WHEN p.source_size > 0 THEN p.target / p.source_size ELSE 0 END AS rate,
         d.size * p.n_docs > 16 * p.source_size AS long
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
drawn AS (
  SELECT *, long AND CAST('0x' || substr(lot, 13, 12) AS BIGINT) / 281474976710656.0::DOUBLE < rate - floor(rate) AS drawn
  FROM rated),
shared AS (
  SELECT *, coalesce(sum(size) FILTER (drawn) OVER s, 0) AS drawn_size,
         coalesce(sum(size) FILTER (NOT long) OVER s, 0) AS other_size,
         CAST('0x' || substr(lot, 1, 12) AS BIGINT) % CAST(ceil(CAST(n_docs AS DOUBLE) / 256) AS BIGINT) AS grp
  FROM drawn WINDOW s AS (PARTITION BY source)),
placed AS (
  SELECT *, floor(fraction * CAST(sum(size) OVER (PARTITION BY source, grp) AS DOUBLE) + 0.5) AS share,
         row_number() OVER w AS place, sum(size) OVER (w ROWS UNBOUNDED PRECEDING) AS last
  FROM (SELECT *, CASE WHEN other_size > 0 THEN least(1, greatest(0,
          ((rate - floor(rate)) * CAST(source_size AS DOUBLE) - CAST(drawn_size AS DOUBLE)) / CAST(other_size AS DOUBLE)))
          ELSE 0 END AS fraction FROM shared WHERE NOT long)
  WINDOW w AS (PARTITION BY source, grp ORDER BY lot, doc_id NULLS FIRST, size)),
gaps AS (
  SELECT *, last <= share AS first,
         share - max(CASE WHEN last <= share THEN last ELSE 0 END) OVER (PARTITION BY source, grp) AS gap
  FROM placed),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source, grp, first ORDER BY abs(size - gap), place) AS near FROM gaps),
chosen AS (
  SELECT doc_id, size, source_size, target, rate,
         CASE WHEN first OR (near = 1 AND abs(size - gap) < gap) THEN 1 ELSE 0 END AS extra FROM ranked
  UNION ALL
  SELECT doc_id, size, source_size, target, rate, CASE WHEN drawn THEN 1 ELSE 0 END FROM drawn WHERE long)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((floor(rate) + extra) * size AS BIGINT) AS taken
FROM chosen
"""
