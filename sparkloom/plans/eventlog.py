"""An append-only log of task events with snapshots of what it folds to.

Events come as folders, each of which counts once it has its name.  A snapshot is the folded state of
all tasks and the names of the folders in it, and becomes valid by one rename; the state of now is
that of the newest snapshot and of the folders that it does not name.  So what a read costs depends on tasks and new
events, not on the length of the history.  Folders that the snapshot before named go to the archive when a new one is made, so a
reader has a whole turn of snapshots to end.  Should an event come so late that the task's later ones
are folded already, that task is folded from its whole history again.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators import broker
from sparkloom.sources.sinks import Files

EVENTS = "task_id string, seq long, at double, action string, token string, answer string"
#: Snapshots that are kept, and folders of events after which a new one is due.
KEPT, DUE = 2, 64
#: Seconds that a writer may take: younger folders are not folded yet.
GRACE = 60.0


class EventLog:
    """``accepts`` says which events count, under the name ``rule``; a snapshot by another rule is not used."""

    def __init__(self, spark: SparkSession, files: Files, seconds: float = broker.LEASE_SECONDS, rule: str = "all", accepts: Column | None = None):
        self.spark, self.files, self.seconds, self.rule, self.accepts = spark, files, seconds, rule, accepts

    def append(self, rows: DataFrame) -> None:
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        self.files.make("events")
        rows.select(*[c.split()[0] for c in EVENTS.split(", ")]).write.parquet(f"{self.files.root}/.{name}")
        self.files.rename(f".{name}", f"events/{name}")

    def names(self, folder: str) -> list[str]:
        return self.files.names(folder) if self.files.exists(folder) else []

    def newest(self) -> dict | None:
        """The manifest of the newest snapshot of this rule."""
        for number in reversed(self.names("snapshots")):
            found = self.files.read_json(f"snapshots/{number}/manifest.json")
            if found["rule"] == self.rule and found["seconds"] == self.seconds:
                return found
        return None

    def pending(self) -> list[str]:
        """Folders of events that the newest snapshot does not name."""
        held = self.newest()
        if held is None:
            return [f"archive/{n}" for n in self.names("archive")] + [f"events/{n}" for n in self.names("events")]
        return [f"events/{n}" for n in self.names("events") if n not in set(held["names"])]

    def read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], EVENTS)
        rows = self.spark.read.schema(EVENTS).parquet(*[f"{self.files.root}/{x}" for x in folders])
        return rows if self.accepts is None else rows.where(self.accepts)

    def history(self) -> DataFrame:
        return self.read([f"{x}/{n}" for x in ("archive", "events") for n in self.names(x)])

    def folded(self, now: float | None = None, folders: list[str] | None = None) -> DataFrame:
        """The state of every task that had an event: broker.FOLDED, as of ``now``."""
        rows, held = self.read(self.pending() if folders is None else folders), self.newest()
        if held is None:
            return broker.fold(rows, self.seconds, now)
        start = self.spark.read.schema(broker.FOLDED).parquet(f"{self.files.root}/snapshots/{held['number']}/state")
        last = start.select(F.col("task_id").alias("__t"), F.struct("at", "seq").alias("last"))
        late = rows.join(last, F.col("task_id") == F.col("__t")).where(F.struct("at", "seq") < F.col("last")).select("task_id").distinct()
        if late.isEmpty():
            return broker.fold(rows, self.seconds, now, start)
        known = broker.fold(rows.join(late, "task_id", "left_anti"), self.seconds, now, start.join(late, "task_id", "left_anti"))
        return known.unionByName(broker.fold(self.history().join(late, "task_id", "left_semi"), self.seconds, now))

    def snapshot(self, grace: float = GRACE) -> int | None:
        """Fold what is pending and older than ``grace`` seconds into a new snapshot; its number, or none if there is
        nothing to fold.  Of two at once one fails.  Wherever it dies, the state stays what it was."""
        upto = f"{time.time_ns() - int(grace * 1e9):020d}"
        held = self.newest()
        chosen = [x for x in self.pending() if x.rsplit("/", 1)[1] < upto]
        if not chosen:
            return None
        state = self.folded(None, chosen)
        hidden = f".snapshot-{uuid.uuid4().hex}"
        state.write.parquet(f"{self.files.root}/{hidden}/state")
        # those that the snapshot before names are no reader's any more
        self.files.make("archive")
        there = set(self.names("events"))
        for n in held["names"] if held else ():
            if n in there:
                self.files.rename(f"events/{n}", f"archive/{n}")
        number = max([0, *map(int, self.names("snapshots"))]) + 1
        name = f"{number:012d}"
        self.files.write_json(f"{hidden}/manifest.json", {"number": name, "names": [x.rsplit("/", 1)[1] for x in chosen if x.startswith("events/")], "rule": self.rule, "seconds": self.seconds})
        self.files.make("snapshots")
        self.files.rename(hidden, f"snapshots/{name}")
        for old in self.names("snapshots")[:-KEPT]:
            self.files.delete(f"snapshots/{old}")
        return number

    def snapshot_if_due(self, due: int = DUE) -> None:
        if len(self.pending()) >= due:
            self.snapshot()
