"""What several operators share: words, seeded keys, groups with nulls, exact distributed ranks."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.operators.layout import stage
from stratamart.session import shared_dir

__all__ = ["WORD", "SPACE", "KEY_BITS", "stage", "Scratch", "table", "word_count", "seeded_key", "marked",
           "slices_for", "slice_of", "running_offsets"]

# A word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

KEY_BITS = 52
# Rows that one window partition sorts.
SLICE_ROWS = 4_000


# Rows that a task hands to Python at once while a scratch table is computed: whole texts are in memory on both sides.
BATCH_ROWS = 2_500


class Scratch:
    """Staged tables that a job removes once nothing reads them any more."""

    def __init__(self, spark) -> None:
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{shared_dir(self.spark)}/stage/{name}-{uuid4().hex}"
        limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = self.spark.conf.get(limit)
        self.spark.conf.set(limit, str(BATCH_ROWS))
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(limit, before)
        staged = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(staged)] = (staged, path)
        return staged

    def drop(self, *staged: DataFrame) -> None:
        """Remove staged tables; only what has itself been staged may have been made of them."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in staged:
            _, path = self.paths.pop(id(df))
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)

    def drop_all(self) -> None:
        self.drop(*(df for df, _ in list(self.paths.values())))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words as long, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_key(column: Column, seed: str) -> Column:
    """An even, repeatable 52-bit number per value and seed; null counts as a value of its own."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(named), 1, KEY_BITS // 4), 16, 10).cast("long")


def marked(column: Column) -> Column:
    """A text that is never null, equal only for equal values, and sorts as they do, null last."""
    return F.when(column.isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), column.cast("string")))


def slices_for(rows: int) -> int:
    """How many slices of the key space keep a slice near ``SLICE_ROWS`` rows."""
    return max(1, -(-rows // SLICE_ROWS))


def slice_of(key: Column, slices: int) -> Column:
    """The slice of a seeded key; slices are ranges, so they follow the order of the keys."""
    width = -(-(2**KEY_BITS) // slices)
    return F.floor(key / F.lit(width)).cast("long")


def running_offsets(df: DataFrame, group: str, part: str, amount: Column) -> DataFrame:
    """Per group and slice: the ``amount`` in earlier slices of the group and in all of them.

    Amounts are added up per slice before the shuffle; a window then runs over slices, not rows.
    """
    sums = df.groupBy(group, part).agg(F.sum(amount).cast("long").alias("__sum"))
    whole = Window.partitionBy(group)
    before = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        group,
        part,
        F.coalesce(F.sum("__sum").over(before), F.lit(0)).cast("long").alias("__before"),
        F.sum("__sum").over(whole).cast("long").alias("__total"),
    )
