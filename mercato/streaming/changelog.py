"""A keyed table kept as a change log with compaction (STR-01).

A batch adds one folder to the log, the latest change of each of its keys,
and becomes visible by one small commit file that lists the folders in
effect: a base with the latest change of every key, and the log folders
since.  Nothing in effect is ever rewritten or deleted, so a job that dies
at any point leaves the table at the last commit, and the batch is simply
done again.  A batch costs what its own rows cost: the base is rewritten
only when the log has grown to a share of it, so each row takes part in few
rewrites however many batches there are.  Deletes stay as tombstones, as a
change older than a delete may come after it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercato.sources import folders

DELETED = "_deleted"


class ChangeLog:
    """The table under ``path``; ``keys`` identify a row, the largest ``seq`` wins."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys=("key",), seq: str = "seq",
                 share: float = 0.5, most_logs: int = 32) -> None:
        self.spark, self.path, self.schema, self.keys, self.seq = spark, path.rstrip("/"), schema, list(keys), seq
        self.share, self.most_logs = share, most_logs

    # -- commits: <path>/_commits/<number>, number = batch + 1
    def _commits(self) -> list[int]:
        return sorted(int(n) for n in folders.names(self.spark, f"{self.path}/_commits") if n.isdigit())

    def state(self) -> dict:
        """The folders in effect: base, its rows, log folders and their rows."""
        done = self._commits()
        if not done:
            return {"batch": -1, "base": None, "base_rows": 0, "logs": [], "log_rows": 0}
        return json.loads(folders.get_text(self.spark, f"{self.path}/_commits/{done[-1]:012d}"))

    def _commit(self, state: dict) -> None:
        folders.put_text(self.spark, f"{self.path}/_commits/{state['batch'] + 1:012d}", json.dumps(state))

    def latest(self, changes: DataFrame) -> DataFrame:
        """Latest change per key: a maximum, so rows are combined before the shuffle."""
        rest = [c for c in self.schema.names if c not in (*self.keys, self.seq)]
        pick = F.max(F.struct(self.seq, *rest)).alias("c")
        return changes.groupBy(*self.keys).agg(pick).select(*self.keys, *[F.col(f"c.{c}").alias(c) for c in (self.seq, *rest)]) \
            .select(*self.schema.names)

    def _read(self, state: dict) -> DataFrame:
        parts = [f"{self.path}/{p}" for p in ([state["base"]] if state["base"] else []) + state["logs"]]
        return self.spark.read.schema(self.schema).parquet(*parts) if parts else self.spark.createDataFrame([], self.schema)

    def _written(self, rows: DataFrame, folder: str) -> int:
        """Rows of a folder, counted by its write; what an earlier try left there is replaced."""
        from pyspark.sql import Observation
        seen = Observation(folder)
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{self.path}/{folder}")
        return seen.get["n"]

    def apply(self, changes: DataFrame, batch: int) -> None:
        """Take in a batch of changes, once: a batch already committed is left alone."""
        state = self.state()
        if batch <= state["batch"]:
            return
        log = f"log/batch={batch:012d}"
        n = self._written(self.latest(changes), log)
        state |= {"batch": batch, "logs": [*state["logs"], log], "log_rows": state["log_rows"] + n}
        if len(state["logs"]) > self.most_logs or state["log_rows"] > max(self.share * state["base_rows"], 1):
            base = f"base/version={batch:012d}"
            rows = self._written(self.latest(self._read(state)), base)
            state |= {"base": base, "base_rows": rows, "logs": [], "log_rows": 0}
        self._commit(state)

    def changes(self) -> DataFrame:
        """The latest change of every key, deletes as tombstones."""
        return self.latest(self._read(self.state()))

    def current(self) -> DataFrame:
        """Rows that are there."""
        return self.changes().where(~F.col(DELETED)).drop(DELETED)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Drop folders and commits that the last ``keep`` commits don't list; returns them."""
        done = self._commits()
        kept = [json.loads(folders.get_text(self.spark, f"{self.path}/_commits/{c:012d}")) for c in done[-keep:]]
        held = {p for s in kept for p in [s["base"], *s["logs"]]}
        newest = max((s["batch"] for s in kept), default=-1)
        gone = [f"{d}/{n}" for d in ("base", "log") for n in folders.names(self.spark, f"{self.path}/{d}")
                if f"{d}/{n}" not in held and "=" in n and int(n.split("=")[1]) <= newest]
        gone += [f"_commits/{c:012d}" for c in done[:-keep]]
        for p in gone:
            folders.drop(self.spark, f"{self.path}/{p}")
        return gone
