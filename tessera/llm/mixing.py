"""Mixing sources to target weights by Pfair scheduling (native).

Sources named in ``targets`` have integer weights; all other sources (NULL
too) are one group of weight ``other``.  With Q the sum of the weights, block
j of a group of weight w is released at slot floor(j * Q / w) and due by slot
ceil((j + 1) * Q / w).  Earliest deadline first among the released blocks then
keeps every group within one block of its share at every slot.  As weights are
integers the schedule repeats after Q slots, so it is computed for one period
(a fold over Q slots, Q being a parameter) and the slot of any block follows
by arithmetic; nothing runs through one task row by row.

A group's rows are ordered by (doc_id, row hash) and cut into blocks of
``block_rows``.  The running number is a range partition, a count per
partition and a running sum over the counts, so a source that holds most rows
is spread over many tasks.  Every row is kept: once a group has ended, its
slots stay empty; ``on_target`` says whether the slot lies before the first
such slot.

Rows: rows equal in doc_id and text share one place; NULL texts are rows like
others; NULL doc_ids come first.  An empty table gives no rows.  Columns of
the input named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._common import id_key, written

#: Target weights of the query and of the pipeline's stage.
TARGETS, OTHER, BLOCK_ROWS = {"src0": 4, "src1": 3, "src2": 2, "src3": 1, "src4": 1}, 9, 16
PLACE = ("mix_group", "mix_block", "mix_slot", "on_target")


def _group(targets: dict[str, int], column: str = "source") -> Column:
    """Index of the group: targets in the order given, then the others."""
    out = F.lit(len(targets))
    for i, name in enumerate(targets):
        out = F.when(F.col(column) == name, i).otherwise(out)
    return out


def period(spark, weights: list[int]) -> DataFrame:
    """(mix_group, nth, at): the slot of each group's nth block in a period."""
    if not weights or any(not isinstance(w, int) or w < 1 for w in weights):
        raise ValueError("weights must be positive integers")
    total = sum(weights)
    w = F.array(*map(F.lit, weights))

    def slot(state: Column, t: Column) -> Column:
        def window(done: Column, i: Column) -> Column:
            own = F.get(w, i)
            due = F.ceil((done + 1) * total / own).cast("int")
            return F.when((done < own) & (F.floor(done * total / own) <= t), F.struct(due.alias("due"), i.alias("i")))

        pick = F.array_min(F.transform(state["done"], window))["i"]
        return F.struct(F.transform(state["done"], lambda c, i: F.when(i == pick, c + 1).otherwise(c)).alias("done"),
                        F.concat(state["out"], F.array(F.struct(pick.alias("g"), F.get(state["done"], pick).alias("nth")))).alias("out"))

    start = F.struct(F.array_repeat(F.lit(0), len(weights)).alias("done"), F.array().cast("array<struct<g:int,nth:int>>").alias("out"))
    order = F.aggregate(F.sequence(F.lit(0), F.lit(total - 1)), start, slot)["out"]
    return spark.range(1, numPartitions=1).select(F.posexplode(order).alias("at", "b")).select(F.col("b.g").alias("mix_group"), F.col("b.nth").alias("nth"), "at")


def places(docs: DataFrame, targets: dict[str, int] = TARGETS, other: int = OTHER, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(_row, mix_group, mix_block, mix_slot, on_target), one per distinct row."""
    weights = [*targets.values(), other]
    total = sum(weights)
    rows = (docs.select(_group(targets).alias("mix_group"), id_key().alias("_d"), F.xxhash64("doc_id", "text", "source").alias("_row"))
            .distinct().repartitionByRange("mix_group", "_d", "_row").withColumn("_part", F.spark_partition_id()))
    rows = written(rows, "mix-rows")
    counts = rows.groupBy("mix_group", "_part").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("mix_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("mix_group", "_part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    local = F.row_number().over(Window.partitionBy("mix_group", "_part").orderBy("_d", "_row")) - 1
    numbered = (rows.withColumn("local", local).join(offsets, ["mix_group", "_part"])
                .withColumn("mix_block", F.floor((F.col("offset") + F.col("local")) / block_rows).cast("bigint")))
    w = F.get(F.array(*map(F.lit, weights)), F.col("mix_group"))
    at = F.broadcast(period(docs.sparkSession, weights))  # sum(weights) rows, a parameter

    def slotted(blocks: DataFrame) -> DataFrame:
        return (blocks.withColumn("nth", (F.col("mix_block") % w).cast("int")).join(at, ["mix_group", "nth"])
                .withColumn("mix_slot", (F.floor(F.col("mix_block") / w) * total + F.col("at")).cast("bigint")))

    # the first slot that a group cannot fill: a row per group
    last = counts.groupBy("mix_group").agg(F.floor(F.sum("n") / block_rows).cast("bigint").alias("mix_block"))
    horizon = F.broadcast(slotted(last).agg(F.min("mix_slot").alias("horizon")))
    return (slotted(numbered).crossJoin(horizon)
            .select("_row", *PLACE[:3], (F.col("mix_slot") < F.col("horizon")).alias("on_target")))


def mix(docs: DataFrame, targets: dict[str, int] = TARGETS, other: int = OTHER, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with mix_group, mix_block, mix_slot and on_target; order by
    (mix_slot, doc_id) to read the mixture."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in PLACE]
    keyed = docs.select(F.xxhash64("doc_id", "text", "source").alias("_row"), F.struct(*rest).alias("_rest"))
    return keyed.join(places(docs, targets, other, block_rows), "_row").select("_rest.*", *PLACE)


def oracle(targets: dict[str, int] = TARGETS, other: int = OTHER, block_rows: int = BLOCK_ROWS) -> str:
    """DuckDB statement of ``mix(documents)`` without text, for unique doc_ids."""
    weights = [*targets.values(), other]
    case = "CASE source " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(targets)) + f" ELSE {len(targets)} END"
    total, n = sum(weights), len(weights)
    return f"""
WITH RECURSIVE groups AS (SELECT unnest({weights}) AS w, unnest(range({n})) AS g),
edf AS (
  SELECT -1 AS t, -1 AS pick, 0 AS nth, list_transform(range({n}), lambda x: 0) AS done
  UNION ALL
  SELECT e.t + 1, p.g, p.nth, list_transform(list_zip(e.done, range({n})), lambda z: z[1]::INT + CASE WHEN z[2] = p.g THEN 1 ELSE 0 END)
  FROM edf e, LATERAL (
    SELECT g, e.done[g + 1] AS nth FROM groups
    WHERE e.done[g + 1] < w AND e.done[g + 1] * {total} // w <= e.t + 1
    ORDER BY -((-(e.done[g + 1] + 1) * {total}) // w), g LIMIT 1) p
  WHERE e.t + 1 < {total}),
blocks AS (
  SELECT doc_id, source, {case} AS g, (row_number() OVER (PARTITION BY {case} ORDER BY doc_id NULLS FIRST) - 1) // {block_rows} AS b FROM documents),
slots AS (
  SELECT k.*, (k.b // groups.w) * {total} + edf.t AS slot FROM blocks k JOIN groups USING (g) JOIN edf ON edf.pick = k.g AND edf.nth = k.b % groups.w),
ends AS (
  SELECT min((c.b // groups.w) * {total} + edf.t) AS horizon
  FROM (SELECT g, count(*) // {block_rows} AS b FROM blocks GROUP BY g) c JOIN groups USING (g) JOIN edf ON edf.pick = c.g AND edf.nth = c.b % groups.w)
SELECT doc_id, source, g::INT AS mix_group, b::BIGINT AS mix_block, slot::BIGINT AS mix_slot, slot < horizon AS on_target
FROM slots, ends"""
