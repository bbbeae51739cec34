"""Named quality rules and the split into clean and quarantined rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.settings import StudyRange

Rule = tuple[str, Column]
REASONS = "_rejection_reasons"


def within(column: str, study: StudyRange) -> Column:
    """Half-open range test; both bounds are literals, so it reaches the Parquet scan."""
    return (F.col(column) >= F.lit(study.start).cast("timestamp")) & (
        F.col(column) < F.lit(study.end).cast("timestamp")
    )


def trip_rules(study: StudyRange) -> list[Rule]:
    # Rule names, their order and their bounds.
    return [
        ("passenger_count_not_null", F.col("passenger_count").isNotNull()),
        ("passenger_count_positive", F.col("passenger_count") > 0),
        ("dropoff_after_pickup", F.col("dropoff_datetime") > F.col("pickup_datetime")),
        ("total_amount_non_negative", F.col("total_amount") >= 0),
        ("pickup_not_null", F.col("pickup_datetime").isNotNull()),
        ("dropoff_not_null", F.col("dropoff_datetime").isNotNull()),
        ("vendor_not_null", F.col("VendorID").isNotNull()),
        ("pickup_in_study_range", within("pickup_datetime", study)),
    ]


def holds(predicate: Column) -> Column:
    """True only where the predicate is true: unknown counts as a failure."""
    return F.coalesce(predicate, F.lit(False))


def reasons(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules, in rule order; empty for a clean row."""
    return F.array_compact(
        F.array(*(F.when(holds(test), F.lit(None)).otherwise(F.lit(name)) for name, test in rules))
    )


def mask(rules: Sequence[Rule]) -> Column:
    """The broken rules as bits of one number, rule ``i`` as bit ``i``; 0 for a clean row. A set of reasons in a few
    bytes of fixed width, which group and travel as such. Up to 63 rules."""
    if len(rules) > 63:
        raise ValueError("a mask has room for 63 rules")
    bits = (F.when(holds(test), F.lit(0)).otherwise(F.lit(1 << i)).cast("long") for i, (_, test) in enumerate(rules))
    return reduce(Column.bitwiseOR, bits)


def named(bits: Column, rules: Sequence[Rule]) -> Column:
    """The names of the rules in a mask, in rule order."""
    return F.array_compact(
        F.array(*(F.when(bits.bitwiseAND(F.lit(1 << i)) != 0, F.lit(name)) for i, (name, _) in enumerate(rules)))
    )


def tag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Every row with its broken rules. One pass serves both sides of the split."""
    return df.withColumn(REASONS, reasons(rules))


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """``(clean, quarantined)``: together exactly the input.

    The clean side filters on the bare predicates, since a filter drops unknowns anyway and the
    bare form can be pushed into the scan.
    """
    clean = df.filter(reduce(Column.__and__, (test for _, test in rules)))
    all_hold = reduce(Column.__and__, (holds(test) for _, test in rules))
    quarantined = tag(df.filter(~all_hold), rules).withColumn(
        "_quarantined_at", F.current_timestamp()
    )
    return clean, quarantined


def split_summary(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """Rows in, clean and quarantined, and the percentage set aside, in one aggregate."""
    all_hold = reduce(Column.__and__, (holds(test) for _, test in rules))
    counts = df.groupBy(*by).agg(
        F.count("*").alias("rows_in"),
        F.count_if(all_hold).alias("rows_clean"),
        F.count_if(~all_hold).alias("rows_quarantine"),
    )
    share = F.col("rows_quarantine") / F.greatest(F.col("rows_in"), F.lit(1)) * 100
    return counts.withColumn("quarantine_pct", share)


def rule_failures(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break each rule, as ``(rule, failed_rows)``: one aggregate over the input, then
    its single row is turned into one row per rule."""
    counted = df.agg(*(F.count_if(~holds(test)).alias(name) for name, test in rules))
    pairs = [F.struct(F.lit(n).alias("rule"), F.col(n).alias("failed_rows")) for n, _ in rules]
    return counted.select(F.inline(F.array(*pairs)))
