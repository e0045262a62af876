"""Sources mixed to target weights along a curriculum that changes with time.

Sources in the order of their code points (null last) weigh 1, 2, 3, and so on again. They
share the words of all documents by weight; a target stops at `most` times its source's
size, and what is over is shared again by weight until none is above. Within its source
every document has a place, by the MD5 digest of its doc_id; the source's words in that
order, again and again, are its stream, of which the mix takes the first `target` words.

Each source has a schedule, a weight at each time from 0 to 1, linear between knots. Its
integral, scaled to the target, is the demand for its words up to that time; a copy of a
document is due when demand reaches its place in the stream. That inverse is its training
position, by which documents are range-sorted. All is counted in whole words, and the last
document taken may be taken in part, so each source meets its target within a word.

Running totals take two steps, over some sqrt(n) ranges of digests and within each, so a
source that holds a third of all rows is summed by many tasks. Nothing depends on partitions
or on run order.

A null text has size 0. Rows that repeat a doc_id, or have none, are documents of their own; such
rows of equal size may take each other's place. A very long text is counted in place. An empty table,
or one without words, gives targets of 0 and takes nothing. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tertulia.llm.rows import keyed, spare
from tertulia.sources.shared import written

WEIGHTS = (1, 2, 3)
MOST = 3
#: Knots (time, weight) by a source's weight: the light sources early, the heavy ones late.
SCHEDULES = {1: ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), 2: ((0.0, 1.0), (1.0, 1.0)), 3: ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5))}


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows with their number, from 0, in a total order; no task sees more than its range."""
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(rows.repartitionByRange(count, *order).withColumn("_part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy(F.col("_part").alias("_of")).count()  # a row for each range
    starts = sizes.select("_of", (F.sum("count").over(Window.orderBy("_of")) - F.col("count")).alias("_start"))
    return ranged.join(starts, F.col("_part") == F.col("_of")).withColumn(
        name, F.col("_start") + F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1).drop("_part", "_of", "_start")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size -> also weight and target."""
    cycle = F.lit(list(weights))
    ranked = written(
        numbered(sources, [F.col("source").asc_nulls_last()], "rank")
        .withColumn("weight", F.get(cycle, (F.col("rank") % len(weights)).cast("int"))), "sources")
    total = int(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        # A source whose share lies above its limit gets the limit; the rest is shared again.
        over = F.col("source_size") * most < F.lit(level) * F.col("weight")
        held, free, n = ranked.agg(
            F.sum(F.when(over, F.col("source_size") * most)), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)).first()
        if n == capped or not free:
            break
        capped, level = n, (total - int(held or 0)) / int(free)
    return ranked.withColumn("target", F.least(F.col("source_size") * float(most), F.lit(level) * F.col("weight")))


def due(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time at which the integral of a schedule reaches a share of its whole."""
    areas = [(b - a) * (v + w) / 2 for (a, v), (b, w) in zip(knots, knots[1:])]
    whole = sum(areas)
    when, done = None, 0.0
    for (a, v), (b, w), area in zip(knots, knots[1:], areas):
        left = share * whole - done
        slope = (w - v) / (b - a)
        root = F.sqrt(F.greatest(v * v + 2 * left * slope, F.lit(0.0)))
        time = F.lit(a) + F.when(root + v > 0, 2 * left / (root + v)).otherwise(0.0)
        done += area
        if area > 0:
            inside = share * whole <= done
            when = F.when(inside, time) if when is None else when.when(inside, time)
    return F.least(when.otherwise(F.lit(knots[-1][0])), F.lit(1.0))


def placed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, schedules: dict = SCHEDULES, *keep: str) -> DataFrame:
    """The kept columns, doc_id, source, size, source_size, target, copies: array of (copy, words, position) that
    the mix takes of it; the position is a time from 0 to 1."""
    sized = written(docs.select(
        *(F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep)), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("place")), "sized")
    ranges = max(1, math.isqrt(sized.count()))
    sized = sized.withColumn(
        "range", F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * ranges / F.lit(1 << 32)))
    sums = written(sized.groupBy("source", "range").agg(F.sum("size").alias("words")), "ranges")
    aims = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    starts = starts.join(aims.select(F.col("source").alias("s"), "source_size", "weight", "target"), F.col("source").eqNullSafe(F.col("s")))
    inside = Window.partitionBy("source", "range").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    starts = starts.select(F.col("s").alias("_s"), F.col("range").alias("_r"), "start", "source_size", "weight", "target")
    rows = rows.join(starts, rows["source"].eqNullSafe(starts["_s"]) & (rows["range"] == starts["_r"]))
    wanted = F.round("target").cast("long")
    copies = []
    for k in range(most):
        at = F.col("start") + F.col("within") + k * F.col("source_size")
        taken = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), wanted - at))
        share = at / F.greatest(wanted, F.lit(1)).cast("double")
        position = F.lit(None).cast("double")
        for weight, knots in schedules.items():
            position = F.when(F.col("weight") == weight, due(share, knots)).otherwise(position)
        copies.append(F.struct(F.lit(k).alias("copy"), taken.alias("words"), position.alias("position")))
    return rows.select(*(F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep)), "doc_id", "source", "size", "source_size", "target",
                       F.filter(F.array(*copies), lambda c: c["words"] > 0).alias("copies"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, schedules: dict = SCHEDULES) -> DataFrame:
    """What the mix takes: a row for each copy of a document, with all its columns, range-sorted
    by the copy's own `mix_position`, with `mix_copy` (from 0) and `mix_taken` (words of it).
    Every row of docs has its own plan, whatever its doc_id. Where docs has a column of one
    of the new names, the new one gets an underscore more."""
    key, copy, of = (spare(docs.columns, c) for c in ("row", "copy", "of"))
    position, number, taken = (spare(docs.columns, f"mix_{c}") for c in ("position", "copy", "taken"))
    rows = keyed(docs, key)
    plan = placed(rows, weights, most, schedules, key).where(F.size("copies") > 0).select(F.col(key).alias(of), F.col("copies").alias(copy))
    out = rows.join(plan, F.col(key) == F.col(of)).select(
        *docs.columns, F.explode(copy).alias(copy))
    out = out.select(*docs.columns, F.col(copy)["position"].alias(position), F.col(copy)["copy"].alias(number), F.col(copy)["words"].alias(taken))
    order = [position, "doc_id", number]
    return out.repartitionByRange(*map(F.col, order)).sortWithinPartitions(*order)


def op9(docs: DataFrame) -> DataFrame:
    """What the mix takes of each document, read from its copies in training order: they are range-sorted
    by position over all sources and numbered. Rows leave in the order of their first copy, those
    without one last."""
    plan = written(placed(docs.withColumn("row", F.monotonically_increasing_id()), WEIGHTS, MOST, SCHEDULES, "row"), "plan")
    copies = plan.select("row", "doc_id", F.explode("copies").alias("c")).select("row", "doc_id", "c.copy", "c.words", "c.position")
    ordered = numbered(copies, [F.col("position"), F.col("doc_id"), F.col("copy"), F.col("row")], "nth")
    drawn = ordered.groupBy(F.col("row").alias("of")).agg(
        F.sum("words").alias("words"), F.min("nth").alias("nth"), F.min_by("position", "nth").alias("position"))
    out = plan.drop("copies").join(drawn, F.col("row") == F.col("of"), "left")
    order = [F.col("nth").asc_nulls_last(), F.col("row")]
    return out.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"),
        F.round("position", 6).alias("first_position"))


def _due_sql(share: str, knots: tuple[tuple[float, float], ...]) -> str:
    areas = [(b - a) * (v + w) / 2 for (a, v), (b, w) in zip(knots, knots[1:])]
    whole, done, cases = sum(areas), 0.0, ""
    for (a, v), (b, w), area in zip(knots, knots[1:], areas):
        left = f"({share} * {whole}::DOUBLE - {done}::DOUBLE)"
        root = f"(sqrt(greatest({v * v}::DOUBLE + 2 * {left} * {(w - v) / (b - a)}::DOUBLE, 0)) + {v}::DOUBLE)"
        done += area
        cases += f" WHEN {share} * {whole}::DOUBLE <= {done}::DOUBLE THEN {a}::DOUBLE + CASE WHEN {root} > 0 THEN 2 * {left} / {root} ELSE 0 END"
    return f"least(CASE{cases} ELSE {knots[-1][0]}::DOUBLE END, 1)"


def oracle(weights: tuple[int, ...] = WEIGHTS, most: int = MOST, schedules: dict = SCHEDULES) -> str:
    """Targets by one pass over the sources in the order of their limits, for documents without repeated ids."""
    times = " ".join(f"WHEN {w} THEN {_due_sql('(began / greatest(wanted, 1)::DOUBLE)', knots)}" for w, knots in schedules.items())
    return f"""WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
    sources AS (SELECT source, sum(size)::BIGINT AS s, [{', '.join(map(str, weights))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1] AS w
      FROM sized GROUP BY source),
    ordered AS (SELECT *, row_number() OVER o AS k, (sum(s) OVER () - (sum(s) OVER o - s) * {most})::DOUBLE / (sum(w) OVER () - sum(w) OVER o + w) AS level
      FROM sources WINDOW o AS (ORDER BY s * {most} / w, source ROWS UNBOUNDED PRECEDING)),
    level AS (SELECT coalesce(arg_min(level, k) FILTER (level * w <= s * {most}), 0) AS level FROM ordered),
    aims AS (SELECT source, s, w, least((s * {most})::DOUBLE, level * w) AS target FROM sources, level),
    streams AS (SELECT d.*, s, w, target, round(target)::BIGINT AS wanted,
      (sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS began
      FROM sized d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source)
    SELECT doc_id, size, s AS source_size, target,
      ({' + '.join(f'greatest(0, least(size, wanted - began - {k} * s))' for k in range(most))})::BIGINT AS taken,
      CASE WHEN least(size, wanted - began) > 0 THEN round(CASE w {times} END, 6) END AS first_position FROM streams"""
