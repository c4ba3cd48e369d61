"""Mixing sources to target weights by thresholds of a hash.

Each document has a point, a hash of its id. Sizes are summed by source and by the
leading bits of the point; in each source the bucket is found in which a budget
runs out; only that bucket is summed again by its next bits. What lies below the
threshold so found is taken: nothing is sorted, and a smaller budget always takes a
part of what a larger one takes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from keybrook.llm.common import look_up, named, put_back, set_apart, word_list, written

SHARE = 1.5
WEIGHTS = (3, 1, 2)
MOST_TIMES = 2
# Nested budgets, as parts of the targets; the last is the mix itself.
STEPS = (0.25, 0.5, 1.0)

POINT_BITS, LEVEL_BITS = 48, 12


def point_of(documents_key: Column) -> Column:
    """A hash of 48 bits, as a number that other engines can also compute."""
    digits = F.substring(F.md5(documents_key), 1, POINT_BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint")


def targets(
    sources: DataFrame, share: float, weights: Sequence[int], most_times: int
) -> DataFrame:
    """``target`` of each source: a share of all sizes dealt by weight, with a ceiling.

    ``sources`` has one row per source, so the windows over all of it are small.
    What a source cannot take is dealt again to the others by weight. In the order
    of ceiling over weight the sources that reach their ceiling come first, so the
    level at which the others meet is found in one pass.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int")
    )
    by_ratio = Window.orderBy(F.col("ceiling") / F.col("weight"), F.col("place"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) * share
        - F.coalesce(F.sum("ceiling").over(before), F.lit(0))
    ) / F.sum("weight").over(after)
    return (
        sources.withColumns({"place": place, "weight": weight})
        .withColumn("ceiling", F.col("source_size") * most_times)
        .withColumn("level", level)
        .withColumn("full", F.col("weight") * F.col("level") > F.col("ceiling"))
        .withColumn(
            "meeting",
            F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(everything),
        )
        .withColumn(
            "target",
            F.when(F.col("full"), F.col("ceiling").cast("double")).otherwise(
                F.col("weight") * F.col("meeting")
            ),
        )
        .select("source_key", "source", "source_size", "target")
    )


def _boundaries(sums: DataFrame, level: str, group: Sequence[str]) -> DataFrame:
    """Where the running sum of ``size`` passes ``rest``; one row per group at most."""
    running = (
        Window.partitionBy(*group).orderBy(level).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        sums.withColumn("until", F.col("before") + F.sum("size").over(running))
        .withColumn("before", F.col("until") - F.col("size"))
        # Nothing left of a budget has no boundary: its threshold is 0.
        .where(F.col("rest") > 0)
        .where((F.col("until") > F.col("rest")) & (F.col("before") <= F.col("rest")))
    )


def thresholds(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each (``source_key``, ``step``) the ``threshold`` that meets ``rest`` best.

    ``budgets`` has ``rest`` below the size of its source. The windows run over the
    4,096 buckets of a source, whatever the number of documents.
    """
    first, second = POINT_BITS - LEVEL_BITS, POINT_BITS - 2 * LEVEL_BITS
    bucket = F.shiftright("point", first)
    within = F.shiftright("point", second).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1))
    coarse = (
        sizes.groupBy("source_key", bucket.alias("bucket")).agg(F.sum("size").alias("size"))
        .where(F.col("size") > 0)
    )
    outer = written(
        _boundaries(
            coarse.join(budgets, "source_key").withColumn("before", F.lit(0).cast("bigint")),
            "bucket",
            ["source_key", "step"],
        ).select("source_key", "step", "bucket", "before", "rest"),
        "mix-outer",
    )
    in_bucket = look_up(
        sizes.withColumn("bucket", bucket), outer, ["source_key", "bucket"], F.col("point")
    )
    fine = (
        in_bucket.groupBy("source_key", "step", "bucket", within.alias("within"))
        .agg(F.sum("size").alias("size"), F.first("before").alias("before"),
             F.first("rest").alias("rest"))
        .where(F.col("size") > 0)
    )
    inner = _boundaries(fine, "within", ["source_key", "step"])
    nearer = F.col("until") - F.col("rest") < F.col("rest") - F.col("before")
    cut = F.shiftleft("bucket", LEVEL_BITS) + F.col("within") + nearer.cast("int")
    return inner.select("source_key", "step", F.shiftleft(cut, second).alias("threshold"))


def _point() -> Column:
    return point_of(F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")))


def _sizes(documents: DataFrame) -> DataFrame:
    return written(
        documents.select(
            "doc_id",
            "source",
            named(F.col("source")).alias("source_key"),
            F.size(word_list(F.col("text"))).cast("bigint").alias("size"),
            _point().alias("point"),
        ),
        "mix-sizes",
    )


def _plan(
    sizes: DataFrame, share: float, weights: Sequence[int], most_times: int, steps: Sequence[float]
) -> DataFrame:
    """One row per source, with the ``cuts`` of each step: whole rounds and a threshold."""
    sources = sizes.groupBy("source_key").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size")
    )
    planned = written(targets(sources, share, weights, most_times), "mix-targets")
    budget = F.col("target") * F.element_at(
        F.array(*[F.lit(float(step)) for step in steps]), F.col("step") + 1
    )
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    budgets = (
        planned.select(
            "*", F.explode(F.array(*[F.lit(n) for n in range(len(steps))])).alias("step")
        )
        .withColumn("whole", whole)
        .select("source_key", "step", "whole",
                (budget - F.col("whole") * F.col("source_size")).alias("rest"))
    )
    cuts = budgets.join(thresholds(sizes, budgets.drop("whole")), ["source_key", "step"], "left")
    per_source = cuts.groupBy("source_key").agg(
        F.sort_array(
            F.collect_list(
                F.struct("step", "whole", F.coalesce("threshold", F.lit(0)).alias("threshold"))
            )
        ).alias("cuts")
    )
    return written(planned.drop("source").join(per_source, "source_key"), "mix-plan")


def _times(cut: Column, point: Column) -> Column:
    return cut["whole"] + (point < cut["threshold"]).cast("bigint")


def mix_sources(
    documents: DataFrame,
    share: float = SHARE,
    weights: Sequence[int] = WEIGHTS,
    most_times: int = MOST_TIMES,
    steps: Sequence[float] = STEPS,
) -> DataFrame:
    """How often the mix takes each document.

    Returns ``doc_id``, ``source``, ``size`` (words), ``source_size``, ``target``,
    ``taken`` (words, repeats counted), ``times`` and ``first_step``: the place in ``steps``
    of the smallest of the nested budgets that takes the document, null if none does.

    Sources in the order of their names, null last, have the given weights in turn.
    A target above the size of its source takes every document once, and some again.
    Null texts have size 0; a null ``doc_id`` is placed by its text. Rows with the same
    ``doc_id`` share a point and are taken together. An empty document is taken when its
    point is, at no cost. Other columns are ignored; no documents give no rows.
    """
    sizes = _sizes(documents)
    plan = _plan(sizes, share, weights, most_times, steps)
    place = F.array_position(F.transform("times_by_step", lambda n: n > 0), F.lit(True))
    return (
        look_up(sizes, plan, "source_key", F.col("point"))
        .withColumn(
            "times_by_step", F.transform("cuts", lambda cut: _times(cut, F.col("point")))
        )
        .withColumn("times", F.element_at("times_by_step", -1))
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("times") * F.col("size")).alias("taken"),
            "times",
            F.when(place > 0, place - 1).alias("first_step"),
        )
    )


def documents_of_mix(
    documents: DataFrame,
    share: float = SHARE,
    weights: Sequence[int] = WEIGHTS,
    most_times: int = MOST_TIMES,
) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its own columns.

    How often depends on the source and the point alone, so the texts stay where they are.
    """
    plan = _plan(_sizes(documents), share, weights, most_times, [1.0]).select(
        F.col("source_key").alias("_source_key"), F.col("cuts").alias("_cuts")
    )
    used = ("doc_id", "text", "source")
    keyed = set_apart(documents, *used).withColumn("_source_key", named(F.col("source")))
    times = _times(F.element_at("_cuts", 1), _point())
    return (
        look_up(keyed, plan, "_source_key", _point())
        .withColumn("_times", times)
        .where("_times > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))))
        .select(*put_back(documents.columns, *used))
    )


ORACLE_SQL = f"""
WITH sizes AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 12))::BIGINT AS point
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place
  FROM sizes GROUP BY source),
weighed AS (
  SELECT *, [{", ".join(map(str, WEIGHTS))}][place % {len(WEIGHTS)} + 1] AS weight,
    source_size * {MOST_TIMES} AS ceiling FROM sources),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM sources)::DOUBLE * {SHARE}::DOUBLE
    - coalesce(sum(ceiling) OVER (ORDER BY ceiling::DOUBLE / weight, place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(weight) OVER (ORDER BY ceiling::DOUBLE / weight, place
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level,
    row_number() OVER (ORDER BY ceiling::DOUBLE / weight, place) AS turn
  FROM weighed),
planned AS (
  SELECT source, source_size, CASE WHEN weight * level > ceiling THEN ceiling::DOUBLE
    ELSE weight * (SELECT arg_min(level, turn) FROM levels WHERE NOT weight * level > ceiling)
    END AS target FROM levels),
budgets AS (
  SELECT source, source_size, step - 1 AS step, target, target * part AS budget,
    CASE WHEN source_size > 0 THEN floor(target * part / source_size)::BIGINT ELSE 0 END AS whole
  FROM planned, (SELECT unnest([{", ".join(f"{s}::DOUBLE" for s in STEPS)}]) AS part,
    unnest(range(1, {len(STEPS) + 1})) AS step)),
rests AS (
  SELECT *, budget - whole * source_size AS rest FROM budgets),
fine AS (
  SELECT source, point >> {POINT_BITS - 2 * LEVEL_BITS} AS cell, sum(size)::BIGINT AS size
  FROM sizes GROUP BY ALL HAVING sum(size) > 0),
running AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY cell) AS until FROM fine),
cuts AS (
  SELECT r.source, r.step, max(cell + CASE WHEN until - rest < rest - (until - size)
      THEN 1 ELSE 0 END) << {POINT_BITS - 2 * LEVEL_BITS} AS threshold
  FROM rests r JOIN running c ON r.source IS NOT DISTINCT FROM c.source
  WHERE rest > 0 AND until > rest AND until - size <= rest GROUP BY ALL),
plan AS (
  SELECT r.*, coalesce(threshold, 0) AS threshold
  FROM rests r LEFT JOIN cuts c
    ON r.source IS NOT DISTINCT FROM c.source AND r.step = c.step),
counted AS (
  SELECT s.doc_id, s.source, s.size, s.point, p.source_size, p.target, p.step,
    p.whole + CASE WHEN s.point < p.threshold THEN 1 ELSE 0 END AS times
  FROM sizes s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, source, size, source_size, target,
  (max(times) FILTER (step = {len(STEPS) - 1}) * size)::BIGINT AS taken,
  max(times) FILTER (step = {len(STEPS) - 1})::BIGINT AS times,
  min(step) FILTER (times > 0) AS first_step
FROM counted GROUP BY doc_id, source, size, point, source_size, target
"""
