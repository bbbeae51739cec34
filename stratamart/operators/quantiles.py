"""Percentiles of stored tables: from sketches kept by folder, and exact ones by distributed selection."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratamart.operators.layout import stage
from stratamart.operators.upsert import in_folders

# Samples a sketch keeps per level: a rank is off by some 0.3 % of the rows, however many folders are merged.
SKETCH_SIZE = 1_000
# Exact selection: values that one task puts in order, and cells that more of them are cut into.
SELECT_VALUES = 100_000
CELLS = 256
GROUP, POINT, VALUE, ROWS = "_by", "_point", "_value", "_rows"


def sketch_columns(columns: Sequence[str]) -> list[Column]:
    size = F.lit(SKETCH_SIZE)
    out = [F.count("*").alias("rows")]
    for c in columns:
        value = F.col(c).cast("double")
        out += [
            F.count(value).alias(f"n_{c}"),
            F.min(value).alias(f"min_{c}"),
            F.max(value).alias(f"max_{c}"),
            F.kll_sketch_agg_double(value, size).alias(f"sketch_{c}"),
        ]
    return out


def sketched(rows: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per group: its rows, and of each column the number of values, their range and a KLL sketch. Sketches
    combine before the shuffle, so a group with a third of all rows costs one sketch a task."""
    return rows.groupBy(*by).agg(*sketch_columns(columns))


def merged_sketches(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The sketches of larger groups, from those of their parts."""
    merged = [F.sum("rows").alias("rows")]
    for c in columns:
        merged += [
            F.sum(f"n_{c}").alias(f"n_{c}"),
            F.min(f"min_{c}").alias(f"min_{c}"),
            F.max(f"max_{c}").alias(f"max_{c}"),
            F.kll_merge_agg_double(f"sketch_{c}").alias(f"sketch_{c}"),
        ]
    return sketches.groupBy(*by).agg(*merged)


def sketched_percentiles(sketches: DataFrame, by: str, column: str, points: Sequence[float]) -> DataFrame:
    """``by``, ``rows``, the range and the percentiles of a column; NULL where it has no value."""
    whole = merged_sketches(sketches, [by], [column])
    found = F.kll_sketch_get_quantile_double(f"sketch_{column}", F.array(*(F.lit(p) for p in points)))
    known = whole.withColumn("_found", F.when(F.col(f"n_{column}") > 0, found))
    named = [F.col("_found")[i].alias(f"{point_name(p)}_{column}") for i, p in enumerate(points)]
    return known.select(by, "rows", f"min_{column}", *named, f"max_{column}").orderBy(by)


def point_name(point: float) -> str:
    return f"p{Decimal(str(point)) * 100:f}".rstrip("0").rstrip(".").replace(".", "_")


def refresh_sketches(
    rows: DataFrame, location: str, folders: Sequence[str], by: Sequence[str], columns: Sequence[str], touched: Sequence[Row]
) -> None:
    """Bring the sketches stored at ``location`` up to date with the ``touched`` folders of a table.

    ``rows`` is the table as read from its folders: the predicate on folder columns prunes all others, so a run after
    a landing reads what has landed. Sketches are stored by the same folders and replaced with them; a folder that
    has lost all its rows is left out by the sketch table only once it is rebuilt.
    """
    if not touched:
        return
    own = [c for c in by if c not in folders]
    fresh = sketched(rows.filter(in_folders(touched)), [*folders, *own], columns)
    # A folder has one row per group: few enough for one file.
    fresh.hint("rebalance", *folders).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *folders
    ).parquet(location)


def stored_sketches(spark: SparkSession, location: str, rows: StructType, folders: Sequence[str], by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The stored sketches of a table with the schema ``rows``; none before the first refresh."""
    schema = StructType()
    for c in dict.fromkeys([*by, *folders]):
        schema.add(c, rows[c].dataType)
    schema.add("rows", "long")
    for c in columns:
        schema.add(f"n_{c}", "long").add(f"min_{c}", "double").add(f"max_{c}", "double").add(f"sketch_{c}", "binary")
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return spark.read.schema(schema).parquet(location)


# --- Exact percentiles -----------------------------------------------------------------------


def narrowed(held: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cut what is held of each bracket down to the values around its wanted rank, until no bracket holds more
    than SELECT_VALUES.

    ``held``: different values with their rows, ``_by``, ``_point``, ``_value``, ``_rows``; ``wanted``: for each bracket
    the ``_rank`` among its rows. A round cuts the values into even cells at approximate percentiles, adds up the rows of
    each, and goes on with the one cell that the rank falls into: all steps combine before they shuffle, and only
    the number of values of the largest bracket reaches the driver. Values that are equal are one, so every round
    leaves some ``2 / CELLS`` of them.
    """
    same = F.col("h._by").eqNullSafe(F.col("w._by")) & (F.col("h._point") == F.col("w._point"))
    while True:
        largest = held.groupBy(GROUP, POINT).count().agg(F.max("count")).first()[0] or 0
        if largest <= SELECT_VALUES:
            return held, wanted
        cuts = held.groupBy(GROUP, POINT).agg(
            F.percentile_approx(VALUE, [(i + 1) / CELLS for i in range(CELLS - 1)], 20 * CELLS).alias("_cuts")
        )
        celled = stage(
            held.alias("h").join(cuts.alias("w"), same)
            .select("h.*", F.size(F.filter("_cuts", lambda cut: cut < F.col(VALUE))).alias("_cell")),
            "selection-cells",
        )
        sums = celled.groupBy(GROUP, POINT, "_cell").agg(F.sum(ROWS).alias("_sum"))
        upto = Window.partitionBy(GROUP, POINT).orderBy("_cell")  # CELLS rows a bracket
        ranked = sums.withColumn("_after", F.sum("_sum").over(upto)).alias("h")
        chosen = stage(
            ranked.join(wanted.alias("w"), same)
            .filter("_after - _sum < _rank and _rank <= _after")
            .select("h._by", "h._point", "_cell", F.expr("_rank - (_after - _sum)").alias("_rank")),
            "selection-wanted",
        )
        held = stage(
            celled.alias("h").join(chosen.alias("w"), same & (F.col("h._cell") == F.col("w._cell"))).select(f"h.{GROUP}", f"h.{POINT}", VALUE, ROWS),
            "selection-held",
        )
        wanted = chosen.select(GROUP, POINT, "_rank")


def exact_percentiles(
    df: DataFrame, column: str, by: str = "taxi_type", points: Sequence[float] = (0.5, 0.95, 0.99), accuracy: int = 10_000
) -> DataFrame:
    """Range and exact percentiles: the smallest value with at least ``point`` of all rows at or
    below it. Neither a sort of all rows nor a large group in one task.

    One pass sketches a bracket around each wanted rank: the sketch is off by rows / accuracy ranks at
    most, so ranks twice as far on either side enclose it. One more pass counts the rows below each
    bracket and takes out the values inside, some 4 / accuracy of the rows; what is left of them is narrowed down
    in rounds (``narrowed``) before any task puts it in order.
    """
    rows = df.filter(F.col(column).isNotNull()).select(by, F.col(column).alias(VALUE))
    margin = 2 / accuracy
    ends = [min(1.0, max(0.0, p + side)) for p in points for side in (-margin, margin)]
    found = rows.groupBy(by).agg(
        F.count("*").alias("_total"),
        F.min(VALUE).alias("_low"),
        F.max(VALUE).alias("_high"),
        F.percentile_approx(VALUE, ends, accuracy).alias("_ends"),
    )
    brackets = stage(found.withColumnRenamed(by, GROUP), "percentiles")
    # One pass: a row counts below a bracket, inside it, or not at all.
    near = rows.join(brackets, F.col(by).eqNullSafe(F.col(GROUP)))

    def mark(i: int) -> Column:
        value, low, high = F.col(VALUE), F.col("_ends")[2 * i], F.col("_ends")[2 * i + 1]
        named = lambda inside: F.struct(F.lit(i).alias("p"), F.lit(inside).alias("inside"))
        return F.when(value < low, named(False)).when(value <= high, named(True))

    marks = F.array_compact(F.array(*(mark(i) for i in range(len(points)))))
    counted = stage(
        near.select(GROUP, VALUE, F.inline(marks))
        .select(GROUP, F.col("p").alias(POINT), F.when(F.col("inside"), F.col(VALUE)).alias(VALUE))
        .groupBy(GROUP, POINT, VALUE)
        .agg(F.count("*").alias(ROWS)),
        "percentile-values",
    )
    lower = counted.filter(F.col(VALUE).isNull()).select(F.col(GROUP).alias("_own"), F.col(POINT).alias("_at"), F.col(ROWS).alias("_below"))
    rank = lambda p: F.greatest(F.ceil(F.lit(Decimal(str(p))) * F.col("_total")).cast("long"), F.lit(1))
    ranks = F.array(*(F.struct(F.lit(i).alias(POINT), rank(p).alias("_rank")) for i, p in enumerate(points)))
    wanted = stage(
        brackets.select(GROUP, F.inline(ranks))
        .join(lower, F.col(GROUP).eqNullSafe(F.col("_own")) & (F.col(POINT) == F.col("_at")), "left")
        .select(GROUP, POINT, (F.col("_rank") - F.coalesce("_below", F.lit(0))).alias("_rank")),
        "percentile-ranks",
    )
    held, wanted = narrowed(counted.filter(F.col(VALUE).isNotNull()), wanted)
    in_order = Window.partitionBy(GROUP, POINT).orderBy(VALUE)  # SELECT_VALUES rows at most
    reached = held.withColumn("_upto", F.sum(ROWS).over(in_order)).alias("h")
    same = F.col("h._by").eqNullSafe(F.col("w._by")) & (F.col("h._point") == F.col("w._point"))
    values = reached.join(wanted.alias("w"), same).filter("_upto >= _rank").groupBy("h._by", "h._point").agg(F.min(VALUE).alias(VALUE))
    answers = values.groupBy(GROUP).agg(
        *(F.max(F.when(F.col(POINT) == i, F.col(VALUE))).alias(f"{point_name(p)}_{column}") for i, p in enumerate(points))
    )
    return (
        answers.alias("a")
        .join(brackets.alias("b"), F.col("a._by").eqNullSafe(F.col("b._by")))
        .select(
            F.col("b._by").alias(by),
            F.col("_low").alias(f"min_{column}"),
            *(f"{point_name(p)}_{column}" for p in points),
            F.col("_high").alias(f"max_{column}"),
        )
        .orderBy(by)
    )
