from datetime import timedelta
from pathlib import Path

from pyspark.sql import Row

from stratamart.plans import progress
from stratamart.plans.progress import Progress, folders_of


def test_what_is_written_again_is_due_again(spark, tmp_path):
    log = Progress(spark, str(tmp_path))
    assert log.latest("written a") == {} and log.due("written a", "taken a") == {}
    log.note("written a", [Row(day="1"), Row(day="2")])
    due = log.due("written a", "taken a")
    assert folders_of(due) == [Row(day="1"), Row(day="2")]
    log.note("written a", [Row(day="2")])  # while the run that took both is under way
    log.note("taken a", due)
    assert folders_of(log.due("written a", "taken a")) == [Row(day="2")]
    log.note("taken a", log.due("written a", "taken a"))
    assert log.due("written a", "taken a") == {}
    log.note("taken a", [])


def test_the_log_is_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(progress, "MOST_FILES", 3)
    log = Progress(spark, str(tmp_path))
    for i in range(8):
        log.note("s", [Row(n=str(i % 5))])
    files = list(Path(log.path("s")).glob("part-*"))
    assert len(files) <= 4 and len(log.latest("s")) == 5
    held = log.latest("s")
    first, last = min(held, key=held.get), max(held, key=held.get)
    log.note("s", {last: held[last] - timedelta(days=1)})  # an older note changes nothing
    assert log.latest("s") == held and folders_of([first])[0].n == "3"
