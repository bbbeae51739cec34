"""What the jobs have done, kept next to the tables, so that a run takes up where the last one ended."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

# Files of a step's log; more are merged into one by the next note.
MOST_FILES = 50


class Progress:
    """A log of items (folders) that a step has written or a later step has taken over. Each note is
    a file of its own, from time to time merged into one; an item that is noted again is due again. Every step
    has a folder of its own, so that sources can be worked on side by side."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = f"{root}/_progress"

    def path(self, step: str) -> str:
        return f"{self.root}/{step.replace(' ', '_')}"

    def folder(self, step: str):
        """The step's folder, which is made if it is not there, and its file system."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(step))
        system = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        system.mkdirs(where)
        return system, where

    def note(self, step: str, items: Iterable[Row | str] | Mapping[str, datetime]) -> None:
        """Items as of now, or each as of the time that it is given with."""
        now = datetime.now(timezone.utc)
        noted = dict(items) if isinstance(items, Mapping) else {_text(i): now for i in items}
        if not noted:
            return
        system, where = self.folder(step)
        old = [f.getPath() for f in system.listStatus(where) if f.getPath().getName().startswith("part-")]
        merged = len(old) >= MOST_FILES
        if merged:
            held = self.latest(step)
            noted = held | {i: max(at, held[i]) if i in held else at for i, at in noted.items()}
        log = self.spark.createDataFrame(list(noted.items()), "item string, at timestamp").coalesce(1)
        log.write.mode("append").parquet(self.path(step))
        # What is merged is there twice until now, which says the same.
        for path in old if merged else []:
            system.delete(path, False)

    def latest(self, step: str) -> dict[str, datetime]:
        """The items of a step, with when they were noted last."""
        self.folder(step)
        log = self.spark.read.schema("item string, at timestamp").parquet(self.path(step))
        found = log.groupBy("item").agg(F.max(F.unix_micros("at")).alias("at"))
        return {r["item"]: datetime.fromtimestamp(r["at"] / 1e6, timezone.utc) for r in found.collect()}

    def due(self, written: str, taken: str) -> dict[str, datetime]:
        """Folders that ``written`` has noted since ``taken`` last did, as ``folders_of`` reads them, with when. Noted with
        these times as taken, they are due again if they were written in the meantime."""
        done = self.latest(taken)
        return {i: at for i, at in sorted(self.latest(written).items()) if i not in done or done[i] < at}


def folders_of(items: Iterable[str]) -> list[Row]:
    return [Row(**json.loads(text)) for text in items]


def _text(item: Row | str) -> str:
    return item if isinstance(item, str) else json.dumps(item.asDict(), default=str, sort_keys=True)
