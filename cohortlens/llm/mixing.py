"""Mixing sources to target weights by capped water-filling (operator 1).

Target of a source: its share of the budget by weight, but at most
``max_epochs`` times its size; what the capped sources leave is shared among the
others by weight, again and again until no target is above its cap.

Every document is then taken ``floor(target / source size)`` times whole, and
the fraction left over is sampled: documents are put in a seeded pseudo-random
order within their source and taken once more up to a cut.  The cut is the one
whose words come nearest to the fraction, so a source misses its target by at
most half of one document, whatever the sizes.  The cut is found from words per
(source, order bucket), then per bucket of the one bucket a source that holds it,
and then inside one of those, so no source is ever sorted as a whole; the
decision about a row is local and rows are not shuffled.

Rows may share a draw: equal ids, or equal texts without id.  Where the fraction
ends inside such a group, its rows alone are written, numbered task by task, and
taken one by one up to the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import BROADCAST_ROWS, HOT_SHARE, WORD, bounded_broadcast, documents, pick, same, stage, without
from cohortlens.schema import safe_col

MAX_EPOCHS = 3.0
SEED = 17
#: Buckets of the sampling order, and of one of its buckets, and so on for LEVELS; the last one is looked at row by row.
BUCKETS = 1024
LEVELS = 2
_DRAW_DIGITS = 15  # hex digits of the draw: 60 bits
OUTPUTS = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_level(caps: DataFrame, budget: int) -> float:
    """Level L with sum(min(cap, L * weight)) = budget, from a table (cap double, weight double).

    Each round clamps the sources whose share exceeds their cap and shares the
    rest anew; one aggregate row reaches the driver a round.  Infinite when the
    budget takes every cap.
    """
    clamped, level = -1, 0.0
    while True:
        over = F.col("cap") <= F.lit(level) * F.col("weight")
        row = caps.agg(
            F.count(F.when(over, 1)).alias("n"),
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)).alias("capped"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if row.n == clamped:
            return level
        clamped = row.n
        if row.open <= 0:
            return float("inf")
        level = (budget - row.capped) / row.open


def source_targets(sizes: DataFrame, weights: DataFrame | None, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, weight, target) from rows (source, size).

    ``weights`` has (source, weight), weights above 0 (others raise); None
    gives the weights 1, 2, 3, repeating, to the sources by code point, null
    last.  A source missing from ``weights`` gets target 0.
    """
    totals = stage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    if weights is None:
        order = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source
        totals = totals.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))
    else:
        given = weights.select(
            safe_col(weights.columns[0]).alias("s"), safe_col(weights.columns[1]).cast("double").alias("weight")
        )
        if given.filter("weight is null or weight <= 0 or isnan(weight)").limit(1).count():
            raise ValueError("weights must be above 0")
        totals = totals.join(given, same(F.col("source"), F.col("s")), "left").drop("s")
    budget = totals.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    cap = F.lit(float(max_epochs)) * F.col("source_size")
    weighted = totals.filter("weight is not null")
    level = water_level(weighted.select(cap.alias("cap"), "weight"), budget)
    target = F.least(cap, F.lit(level) * F.col("weight"))
    return totals.withColumn("target", F.coalesce(target, F.lit(0.0)))


def _draw(seed: int, id_col: Column, text: Column) -> Column:
    """60-bit pseudo-random number of a row, from the seed and its id (from its text where the id is null)."""
    tag = F.coalesce(id_col.cast("string"), F.concat(F.lit("?"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), tag)), 1, _DRAW_DIGITS), 16, 10).cast("long")


def hot_sources(sizes: DataFrame, n_sources: int) -> DataFrame | None:
    """(hot): the at most HOT_SHARE sources with 1/HOT_SHARE of the rows or more; None if all sources may be broadcast."""
    if n_sources <= BROADCAST_ROWS:
        return None
    counts = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return stage(counts.filter(F.col("n") * HOT_SHARE >= F.lit(sizes.count())).select(F.col("source").alias("hot")), "mix-hot")


def _of_source(rows: DataFrame, table: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Inner join of ``rows`` (source) with ``table``, at most one row a source ``s``; rows of hot sources are not shuffled."""
    held = same(F.col("source"), F.col("s"))
    if hot is None:
        return rows.join(F.broadcast(table), held)
    few = table.join(F.broadcast(hot), same(F.col("s"), F.col("hot")), "left_semi")
    rest = rows.join(F.broadcast(hot), same(F.col("source"), F.col("hot")), "left_anti")
    return rows.join(F.broadcast(few), held).unionByName(rest.join(table, held))


def sampling_cuts(sizes: DataFrame, targets: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(source, whole, cut, tie, need): every row is taken ``whole`` times, and once more where its draw is at most ``cut``.

    Where the fraction ends among several rows of one draw, that draw is ``tie``
    (above the cut) and ``need`` the words still to be taken from its rows.
    """
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    want = targets.select(
        "source",
        F.floor(rate).alias("whole"),
        (F.col("target") - F.floor(rate) * F.col("source_size")).alias("extra"),
    )
    width = 1 << (4 * _DRAW_DIGITS)
    # The stretch of the order that holds a source's cut: its first draw, and the words before it.
    edge = want.select(
        F.col("source").alias("s"), F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("before"), "extra"
    )
    upto = Window.partitionBy("source").orderBy("low").rowsBetween(Window.unboundedPreceding, 0)

    def within(width: int) -> DataFrame:
        return _of_source(sizes, edge, hot).filter((F.col("draw") >= F.col("low")) & (F.col("draw") < F.col("low") + width))

    for _ in range(LEVELS):
        rows, width = within(width), width // BUCKETS
        low = F.col("draw") - F.pmod("draw", F.lit(width))
        edge = stage(
            rows.groupBy("source", low.alias("low"), "before", "extra")
            .agg(F.sum("size").alias("words"))
            .withColumn("before", F.col("before") + F.sum("words").over(upto) - F.col("words"))
            .filter("before <= extra and extra < before + words")
            .select(F.col("source").alias("s"), "low", "before", "extra"),
            "mix-edges",
        )
    inside = within(width).groupBy("source", "draw", "before", "extra").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")
    )
    along = Window.partitionBy("source").orderBy("draw").rowsBetween(Window.unboundedPreceding, 0)
    # Prefixes of the order: all before the bucket (cut just below it), or up to one of its draws.
    steps = inside.withColumn("taken", F.col("before") + F.sum("words").over(along))
    start = edge.select(
        F.col("s").alias("source"),
        (F.col("low") - 1).alias("draw"),
        F.col("before").alias("taken"),
        "extra",
    )
    ends_inside = (F.col("n") > 1) & (F.col("taken") > F.col("extra")) & (F.col("taken") - F.col("words") <= F.col("extra"))
    tie = F.when(ends_inside, F.struct("draw", (F.col("extra") - F.col("taken") + F.col("words")).alias("need")))
    cuts = (
        steps.select("source", "draw", "taken", "extra", tie.alias("tie"))
        .unionByName(start.withColumn("tie", F.lit(None).cast("struct<draw:bigint,need:double>")))
        .groupBy("source")
        .agg(F.min(F.struct(F.abs(F.col("taken") - F.col("extra")).alias("miss"), "draw")).alias("best"), F.max("tie").alias("tie"))
        .select(F.col("source").alias("s"), F.coalesce(F.col("tie.draw") - 1, F.col("best.draw")).alias("cut"), "tie")
    )
    return want.join(cuts, same(F.col("source"), F.col("s")), "left").select(
        "source",
        "whole",
        # Nothing is left over: no row is taken once more, empty ones neither.
        F.when(F.col("extra") > 0, F.coalesce("cut", F.lit(-1))).otherwise(-1).alias("cut"),
        F.when(F.col("extra") > 0, F.col("tie.draw")).alias("tie"),
        F.when(F.col("extra") > 0, F.col("tie.need")).alias("need"),
    )


def _split_ties(tied: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` of the rows of a source's tie, with ``once``: 1 for those that the fraction takes, one after the other.

    Rows are numbered within the task that wrote them; before a task come the
    words of the tasks before it, one row a source and task.
    """
    held = stage(
        tied.withColumns({"task": F.spark_partition_id(), "row": F.monotonically_increasing_id()}), "mix-ties"
    )
    words = held.groupBy("source", "task").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(words.select(F.col("source").alias("s"), F.col("task").alias("t"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")), "mix-offsets")
    within = Window.partitionBy("source", "task").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    numbered = held.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
    match = same(F.col("source"), F.col("s")) & (F.col("task") == F.col("t"))
    joined = numbered.join(bounded_broadcast(offsets, offsets.count()), match)
    nearer = F.col("offset") + F.col("ahead") + F.col("size") / 2 < F.col("need")
    return joined.select(*keep, F.when(nearer, 1).otherwise(0).alias("once"))


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row with size, source_size, target (of its source), copies and taken = copies * size.

    ``carry`` names the columns to return (default: all); outputs replace input
    columns of the same names.  A null text or one without words has size 0; a
    null source is a source of its own.  Rows with equal id share their draw, rows
    without id draw by their text; where the fraction ends among rows of one draw,
    as many of them are taken as come nearest to it (which, is settled by their
    order in the input).  No row has more than ``max_epochs`` copies, rounded up.
    An empty table gives an empty result.  Reruns give the same result.
    ``repeat_rows`` turns copies into rows.
    """
    text = safe_col(text_col).cast("string")
    sizes = stage(
        docs.select(
            safe_col(source_col).cast("string").alias("source"),
            word_count(text).alias("size"),
            _draw(seed, safe_col(id_col), text).alias("draw"),
        ),
        "mix-sizes",
    )
    targets = stage(source_targets(sizes, weights, max_epochs), "mix-targets")
    n_sources = targets.count()
    hot = hot_sources(sizes, n_sources)
    cuts = sampling_cuts(sizes, targets, hot)
    plan = stage(
        targets.join(cuts.withColumnRenamed("source", "s"), same(F.col("source"), F.col("s"))).select(
            "s", "source_size", "target", "whole", "cut", "tie", "need"
        ),
        "mix-plan",
    )
    carried = without(docs.select(*[safe_col(c) for c in (carry or docs.columns)]), OUTPUTS).columns
    names = [f"c{i}" for i in range(len(carried))]
    rows = docs.select(
        *[safe_col(c).alias(n) for c, n in zip(carried, names)],
        safe_col(source_col).cast("string").alias("source"),
        word_count(text).alias("size"),
        _draw(seed, safe_col(id_col), text).alias("draw"),
    )
    planned = _of_source(rows, plan, hot).drop("s")
    keep = [*names, "size", "source_size", "target", "whole"]
    once = F.when(F.col("draw") <= F.col("cut"), 1).otherwise(0)
    if plan.filter("tie is not null").isEmpty():
        counted = planned.select(*keep, once.alias("once"))
    else:
        tied = F.coalesce(F.col("draw") == F.col("tie"), F.lit(False))
        counted = planned.filter(~tied).select(*keep, once.alias("once")).unionByName(_split_ties(planned.filter(tied), keep))
    copies = F.least(F.col("whole") + F.col("once"), F.ceil(F.lit(float(max_epochs)))).cast("int")
    return counted.select(
        *[F.col(n).alias(c) for n, c in zip(names, carried)],
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as ``copies`` says, without the operator's columns; no rows give none.

    Rows of null and empty texts are repeated like others.
    """
    kept = without(mixed, OUTPUTS).columns
    rows = mixed.select(
        *[safe_col(c).alias(f"c{i}") for i, c in enumerate(kept)],
        F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"),
    )
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)])


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's size and target, and the words the mix takes from it."""
    docs = pick(documents(spark, sf_dir), doc_id="doc_id", text="text", source="source")
    mixed = mix_sources(docs, carry=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '?' || coalesce(text, ''))), 1, {_DRAW_DIGITS}))::BIGINT AS draw
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size, {MAX_EPOCHS}::DOUBLE * source_size AS cap,
         ((row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM totals),
levels AS (
  SELECT cap / weight AS ratio, cap, weight,
         ((SELECT sum(source_size) FROM totals)::DOUBLE - (sum(cap) OVER u - cap)) / (sum(weight) OVER d) AS level
  FROM weighted
  WINDOW u AS (ORDER BY cap / weight, source ROWS UNBOUNDED PRECEDING),
         d AS (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
water AS (SELECT min(level) AS level FROM (SELECT level FROM levels WHERE level < ratio ORDER BY ratio LIMIT 1)),
targets AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT level FROM water), 'infinity'::DOUBLE) * weight) AS target
  FROM weighted),
wanted AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
fractions AS (SELECT *, target - whole * source_size AS extra FROM wanted),
draws AS (SELECT source, draw, sum(size) AS words FROM sized GROUP BY source, draw),
prefixes AS (
  SELECT d.source, d.draw, sum(d.words) OVER (PARTITION BY d.source ORDER BY d.draw ROWS UNBOUNDED PRECEDING) AS taken, f.extra
  FROM draws d JOIN fractions f ON d.source IS NOT DISTINCT FROM f.source
  UNION ALL SELECT source, -1, 0, extra FROM fractions),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY abs(taken::DOUBLE - extra), draw) AS r FROM prefixes)
SELECT s.doc_id, s.size, f.source_size, f.target,
       ((f.whole + CASE WHEN s.draw <= c.draw THEN 1 ELSE 0 END) * s.size)::BIGINT AS taken
FROM sized s
JOIN fractions f ON s.source IS NOT DISTINCT FROM f.source
JOIN ranked c ON c.r = 1 AND c.source IS NOT DISTINCT FROM s.source
"""
