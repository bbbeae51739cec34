"""Sharding by proportional stratified interleaving.

Rows of a source are ranked in a seeded shuffle; a row's fractional rank (rank + 1/2) / rows says
how far through its source it lies. Sorted by fractional rank, all sources advance together, so any
run of consecutive rows holds the sources in the proportions of the whole, and cutting the order
into equal runs gives shards that all match the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import marked, running_offsets, seeded_key, slice_of, slices_for

SEED = "shards-1"


def interleave(
    df: DataFrame,
    n_shards: int,
    source: str = "source",
    key: str = "doc_id",
    ties: tuple[str, ...] = (),
    seed: str = SEED,
) -> DataFrame:
    """All rows and columns of ``df`` plus ``shard`` (int) and ``slot`` (long, gapless from 0).

    Sizes: row counts of shards differ by at most one. Rows with one ``key`` follow each other by
    ``ties``; rows equal in those as well are interchangeable. A null source is a source of its own, a
    null key a key of its own. An empty table gives an empty table. Columns of ``df`` that are named
    ``shard`` or ``slot`` are replaced.

    Both ranks are exact without any task seeing a whole source: the shuffle keys are even, so ranges
    of them cut the largest source into slices of some 4,000 rows; a slice's offset comes from counts.
    """
    rows = df.count()
    slices = slices_for(rows)
    held = [c for c in df.columns if c not in ("shard", "slot")]
    keyed = (
        df.select(*held)
        .withColumns({"__source": marked(F.col(source)), "__key": seeded_key(F.col(key), seed)})
        .withColumn("__slice", slice_of(F.col("__key"), slices))
    )
    offsets = running_offsets(keyed, "__source", "__slice", F.lit(1))
    order = Window.partitionBy("__source", "__slice").orderBy("__key", key, *ties)
    ranked = (
        keyed.join(offsets, ["__source", "__slice"])
        .withColumn("__rank", F.col("__before") + F.row_number().over(order) - 1)
        .withColumn("__run", F.expr(f"((2 * __rank + 1) * {slices}L) div (2 * __total)"))
        .withColumn("__fraction", F.expr("(2 * __rank + 1) / (2.0D * __total)"))
    )
    # Rows of a source whose fractional rank is below run / slices: a closed form, so the second
    # order needs no second pass over the rows.
    starts = (
        offsets.select("__source", "__total")
        .distinct()
        .withColumn("__run", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
        .groupBy("__run")
        .agg(
            F.sum(F.expr(f"((2 * __total * __run + {slices - 1}L) div {slices}L) div 2"))
            .cast("long")
            .alias("__start")
        )
    )
    along = Window.partitionBy("__run").orderBy("__fraction", "__source", "__rank")
    total = max(rows, 1)
    return (
        ranked.join(starts, "__run")
        .withColumn("__place", F.col("__start") + F.row_number().over(along) - 1)
        .withColumn("shard", F.expr(f"(__place * {n_shards}L) div {total}L").cast("int"))
        .withColumn(
            "slot", F.expr(f"__place - (shard * {total}L + {n_shards - 1}L) div {n_shards}L")
        )
        .select(*held, "shard", "slot")
    )


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One folder per shard; each file is sorted by slot, and large shards take several tasks. Rows are written as
    they are, nulls and repeated ones too; an empty table leaves an empty folder. What was in ``folder`` is replaced."""
    (
        sharded.hint("rebalance", "shard")
        .sortWithinPartitions("shard", "slot")
        .write.mode("overwrite")
        .partitionBy("shard")
        .parquet(folder)
    )
