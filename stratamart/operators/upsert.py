"""Keyed upsert without a transactional table format."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from stratamart.contracts import TableContract
from stratamart.operators.checks import SourceReport, inspect_source, require_sound
from stratamart.operators.layout import replace_folders, with_folders
from stratamart.sources.tables import TableStore


def merge_rows(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Source rows, plus the target rows whose key the source does not hold. Nothing is deleted,
    and a NULL key matches nothing."""
    kept = target.join(source.select(*key), list(key), "left_anti").select(*target.columns)
    return kept.unionByName(source.select(*target.columns))


def in_folders(folders: Sequence[Row]) -> Column:
    """Exactly the given folders, as a predicate on folder columns that prunes the listing:
    equality on the leading columns, one IN list for the last."""
    if not folders:
        return F.lit(False)
    *lead, last = folders[0].__fields__
    head = lambda r: tuple(r[c] for c in lead)
    ordered = sorted(folders, key=lambda r: tuple(map(str, head(r))))
    tests = []
    for values, members in groupby(ordered, key=head):
        same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(lead, values)]
        rows = [r[last] for r in members]
        listed = [v for v in rows if v is not None]
        wanted = F.col(last).isin(listed) if listed else F.lit(False)
        if len(listed) < len(rows):
            wanted = wanted | F.col(last).isNull()
        tests.append(reduce(Column.__and__, same, wanted))
    return reduce(Column.__or__, tests)


def upsert(
    store: TableStore, layer: str, contract: TableContract, source: DataFrame
) -> SourceReport:
    """Merge ``source`` into a stored table; refused as a whole if the source is not sound.

    A trip's folder follows from columns inside its key, so a key can only ever be in one
    folder. That keeps the merge local: only the folders the source touches are read, joined and
    rewritten. Tasks write to a staging folder that replaces the old folders once all tasks have
    finished, so lost executors only repeat tasks. The replacing goes folder by folder and is
    not one transaction: should the driver be lost within it, rerun the job over all of its
    input rather than the newest part. Every row derives from there, so that restores the table.

    The source is read three times, for its keys twice. Where it is costly to compute, pass it
    through :func:`stratamart.operators.layout.stage` first.
    """
    source = with_folders(source, contract)
    report = inspect_source(source, contract)
    require_sound(source, contract, report)
    if report.rows:
        touched = store.read(layer, contract).filter(in_folders(report.folders))
        merged = merge_rows(touched, source, contract.key)
        replace_folders(merged, contract, store.location(layer, contract))
        store.refresh(layer, contract, report.folders)
    return report
