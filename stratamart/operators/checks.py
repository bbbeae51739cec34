"""Checks that run before data is published, each as one aggregate pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from stratamart.contracts import TableContract
from stratamart.operators.rules import holds


def key_hash(*key: str) -> Column:
    return F.xxhash64(*key)


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Key values held by more than one row, with their ``count``.

    Rows are first counted by a hash of their key, so that 8 bytes a key are shuffled instead of, say, 64
    characters; counts combine before that, so a key with a large share of all rows costs one partial row per
    task. Only keys whose hash is not unique are then counted themselves, which tells duplicates from collisions.
    Hashes that occur twice are few where keys are mostly unique, and sent to the rows; else both sides are
    met by a shuffle of hashes.
    """
    suspects = df.groupBy(key_hash(*key).alias("_suspect")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_suspect")
    met = df.select(*key).join(suspects, key_hash(*key) == F.col("_suspect"), "left_semi")
    return met.groupBy(*key).agg(F.count("*").alias("count")).filter("count > 1")


def top_duplicate_keys(df: DataFrame, key: str, sample: int = 10) -> DataFrame:
    return duplicate_keys(df, key).orderBy(F.desc("count"), F.asc(key)).limit(sample)


def duplicates_message(df: DataFrame, key: str, found: int, sample: int = 10) -> str:
    worst = ", ".join(f"{r[0]} ({r[1]} rows)" for r in top_duplicate_keys(df, key, sample).collect())
    return (
        f"{found} values of {key} occur in more than one row of what is to be merged, most often {worst}. "
        f"Was a file ingested twice, or does {key} not tell all rows apart?"
    )


def keep_one(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key, the greatest one: an answer to rows that are true copies. A greatest
    struct combines before the shuffle, unlike a window over each key."""
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select(*key, "_best.*").select(*df.columns)


def latest_copy(df: DataFrame, stamp: str) -> DataFrame:
    """One row of those that agree in everything but ``stamp``, the latest: an answer to copies where
    all columns follow from the key. A plain hash aggregate, which sorts nothing."""
    rest = [c for c in df.columns if c != stamp]
    return df.groupBy(*rest).agg(F.max(stamp).alias(stamp)).select(*df.columns)


def constraint_violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """``(check_name, violations)`` for every NOT NULL column and check of the contract."""
    tests = _tests(contract)
    counted = df.agg(*(F.count_if(~holds(F.expr(t))).alias(n) for n, t in tests.items()))
    pairs = [F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in tests]
    return counted.select(F.inline(F.array(*pairs)))


def asserted(df: DataFrame, contract: TableContract) -> DataFrame:
    """``df``, which fails while it is computed where a row breaks NOT NULL or a check, naming the first one: the hard
    form of the gate, inside the plan that writes. Every column goes through it, so no pruning removes it."""
    broken = F.lit(None).cast("string")
    for name, test in reversed(_tests(contract).items()):
        broken = F.when(~holds(F.expr(test)), F.lit(name)).otherwise(broken)
    sound = {
        c: F.when(broken.isNull(), F.col(c)).otherwise(
            F.raise_error(F.concat(F.lit(f"{contract.name} refuses a row: "), broken)).cast(df.schema[c].dataType)
        )
        for c in df.columns
    }
    return df.withColumns(sound)


def _tests(contract: TableContract) -> dict[str, str]:
    required = {f"{c}_required": f"{c} IS NOT NULL" for c in contract.required}
    return {**required, **contract.checks}


@dataclass(frozen=True)
class SourceReport:
    """What a merge source holds: its rows, the folders it touches, what is wrong with it."""

    rows: int
    folders: list[Row]
    duplicated_keys: int
    violations: dict[str, int]


def inspect_source(source: DataFrame, contract: TableContract) -> SourceReport:
    """Uniqueness, NOT NULL, checks and touched folders in one shuffle on a hash of the key.

    ``source`` carries the folder columns, which must follow from the key. What reaches the
    driver is one row per touched folder, so its size is that of the calendar. Where a hash occurs twice, the
    keys themselves are counted as well.
    """
    tests = _tests(contract)
    per_key = source.groupBy(*contract.partition_by, key_hash(*contract.key).alias("_hash")).agg(
        F.count("*").alias("_copies"),
        *(F.count_if(~holds(F.expr(t))).alias(n) for n, t in tests.items()),
    )
    per_folder = per_key.groupBy(*contract.partition_by).agg(
        F.sum("_copies").alias("_rows"),
        F.count_if(F.col("_copies") > 1).alias("_duplicated"),
        *(F.sum(n).alias(n) for n in tests),
    )
    found = per_folder.collect()
    duplicated = sum(r["_duplicated"] for r in found)
    if duplicated:
        duplicated = duplicate_keys(source, *contract.key).count()
    return SourceReport(
        rows=sum(r["_rows"] for r in found),
        folders=[Row(**{c: r[c] for c in contract.partition_by}) for r in found],
        duplicated_keys=duplicated,
        violations={n: sum(r[n] for r in found) for n in tests},
    )


def require_sound(source: DataFrame, contract: TableContract, report: SourceReport) -> None:
    """Raise before anything is written."""
    broken = {name: n for name, n in report.violations.items() if n}
    if broken:
        listed = ", ".join(f"{name}: {n} rows" for name, n in sorted(broken.items()))
        raise ValueError(f"{contract.name} refuses its source: {listed}")
    if report.duplicated_keys:
        key = contract.key[0]
        raise ValueError(duplicates_message(source, key, report.duplicated_keys))


def orphans(rows: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """Rows without a partner in a dimension; a NULL key has none."""
    keys = dimension.select(F.col(key).alias("_key"))
    return rows.join(keys, F.col(column) == F.col("_key"), "left_anti")


def orphan_counts(rows: DataFrame, links: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row: ``rows`` and ``orphans_<column>`` for each ``column -> (dimension, key)``.

    Each link is counted for itself, without a join: rows per key value and the keys of the dimension are one relation,
    which combines before the shuffle to the size of the dimension. A scan per link reads that one column.
    """
    parts = []
    for column, (dimension, key) in links.items():
        known = dimension.select(F.col(key).alias("_key"), F.lit(True).alias("_known")).filter("_key IS NOT NULL")
        both = rows.select(F.col(column).alias("_key"), F.lit(False).alias("_known")).unionByName(known)
        counted = both.groupBy("_key").agg(F.count_if(~F.col("_known")).alias("_n"), F.max("_known").alias("_known"))
        lost = F.coalesce(F.sum(F.when(~F.col("_known"), F.col("_n"))), F.lit(0))
        total = F.coalesce(F.sum("_n"), F.lit(0))
        parts.append(counted.agg(F.lit(column).alias("_link"), total.alias("_rows"), lost.alias("_lost")))
    return reduce(DataFrame.unionByName, parts).agg(
        F.max("_rows").alias("rows"),
        *(F.max(F.when(F.col("_link") == c, F.col("_lost"))).alias(f"orphans_{c}") for c in links),
    )


def key_bitmaps(keys: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """The integers of a column as bitmaps of 32,768 neighbours each: ``_bucket``, ``_bits``. Exact, and 4 KB for
    what would be up to 32,768 keys in a shuffle; they combine before it. NULL is no key."""
    key = F.col(column).cast("long")
    return (
        keys.filter(key.isNotNull())
        .groupBy(*by, F.bitmap_bucket_number(key).alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("_bits"))
    )


def orphan_keys(rows: DataFrame, links: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``link``, ``used`` and ``orphan_keys``: how many different integer keys the rows use for each
    ``column -> (dimension, key)``, and how many of these the dimension lacks. By difference of bitmaps: what both
    hold together less what the dimension holds. A NULL refers to nothing and is no key."""
    parts = []
    for column, (dimension, key) in links.items():
        sides = [(rows, column, False), (dimension, key, True)]
        both = reduce(
            DataFrame.unionByName, [key_bitmaps(df, c).withColumn("_known", F.lit(known)) for df, c, known in sides]
        )
        known_bits = F.max(F.when(F.col("_known"), F.bitmap_count("_bits")))
        used_bits = F.max(F.when(~F.col("_known"), F.bitmap_count("_bits")))
        counted = both.groupBy("_bucket").agg(
            F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_all"),
            F.coalesce(known_bits, F.lit(0)).alias("_in_dimension"),
            F.coalesce(used_bits, F.lit(0)).alias("_used"),
        )
        parts.append(
            counted.agg(
                F.lit(column).alias("link"),
                F.coalesce(F.sum("_used"), F.lit(0)).alias("used"),
                F.coalesce(F.sum(F.expr("_all - _in_dimension")), F.lit(0)).alias("orphan_keys"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def require_links(rows: DataFrame, links: Mapping[str, tuple[DataFrame, str]]) -> dict[str, int]:
    counts = orphan_counts(rows, links).first().asDict()
    lost = {n: v for n, v in counts.items() if n != "rows" and v}
    if lost:
        raise ValueError(f"rows without a matching dimension row: {lost}")
    return counts


def require_rows(df: DataFrame, expected: int, name: str) -> int:
    found = df.count()
    if found != expected:
        raise ValueError(f"{name} should have {expected} rows, found {found}")
    return found
