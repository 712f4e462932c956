"""The durable cluster tables and their commit.

Layout under one folder: ``<table>/batch=<id>`` for what a batch adds (scan_list, sample_list,
store, merge_candidates, rejects), the same path for what a batch replaces (consensus, singletons), and
``_commits/<id>.json`` written last. Readers see only committed batches, so a run that died
half-way leaves nothing behind that counts, and running it again overwrites its own folders.

An appended table can be compacted: its committed rows go to one new folder, and the record
``_compactions/<table>/<last batch>.json``, written last too, tells readers to open that folder in
place of those batches. ``drop_replaced`` then frees the old folders.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom import schemas
from peakloom.operators.store import latest, lookup, point
from peakloom.session import delete, exists, list_names, read_text, write_table, write_text

REJECTS = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("index", T.LongType()), T.StructField("error", T.StringType())]
)
CANDIDATES = T.StructType([T.StructField("kept_id", T.LongType()), T.StructField("other_id", T.LongType())])
APPENDED = {
    "scan_list": schemas.SCAN_LIST,
    "sample_list": schemas.SAMPLE_LIST,
    "store": schemas.STORE,
    "merge_candidates": CANDIDATES,
    "rejects": REJECTS,
}
# Sort order of compacted tables, so that lookups by key skip row groups.
SORTED = {
    "scan_list": ["cluster_id", "path", "scan"],
    "sample_list": ["cluster_id", "sample_no"],
    "store": ["path", "scan"],
    "merge_candidates": ["kept_id", "other_id"],
    "rejects": ["path", "index"],
}
REPLACED = {"consensus": schemas.CONSENSUS, "singletons": schemas.STORE}


@dataclass(frozen=True)
class State:
    spark: SparkSession
    folder: str

    def commits(self) -> list[int]:
        names = list_names(self.spark, f"{self.folder}/_commits")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def meta(self, batch_id: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.folder}/_commits/{batch_id:012d}.json"))

    def committed(self, batch_id: int) -> bool:
        return exists(self.spark, f"{self.folder}/_commits/{batch_id:012d}.json")

    def max_cluster_id(self) -> int:
        done = self.commits()
        return self.meta(done[-1])["max_cluster_id"] if done else 0

    def path(self, table: str, batch_id: int) -> str:
        return f"{self.folder}/{table}/batch={batch_id}"

    def read(self, table: str) -> DataFrame:
        """Committed rows: all batches of an appended table, the last one of a replaced table."""
        done = self.commits()
        schema = APPENDED.get(table) or REPLACED[table]
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*self.live_folders(table))

    def live_folders(self, table: str) -> list[str]:
        """Folders that hold the committed rows: the newest compacted one and the batches after it."""
        done = self.commits()
        if table not in APPENDED:
            return [self.path(table, b) for b in done[-1:]]
        through = self._compacted(table)
        if through is None:
            return [self.path(table, b) for b in done]
        record = json.loads(read_text(self.spark, f"{self.folder}/_compactions/{table}/{through:012d}.json"))
        later = [self.path(table, b) for b in done if b > through]
        return [f"{self.folder}/{table}/{record['folder']}", *later]

    def _compacted(self, table: str) -> int | None:
        """The last batch that a compacted folder of the table holds."""
        names = list_names(self.spark, f"{self.folder}/_compactions/{table}")
        return max((int(n[:-5]) for n in names if n.endswith(".json")), default=None)

    def store(self) -> DataFrame:
        """The spectrum store with the last write of each (path, scan)."""
        return latest(self.read("store"), ["batch_id"])

    def stored(self, wanted: DataFrame) -> DataFrame:
        """Stored spectra of the wanted (path, scan), last writes only.

        Unwanted rows go before the last write is chosen, so their peaks are not sorted.
        """
        return latest(lookup(self.read("store"), wanted), ["batch_id"])

    def write(self, table: str, batch_id: int, df: DataFrame) -> DataFrame:
        schema = APPENDED.get(table) or REPLACED[table]
        path = self.path(table, batch_id)
        write_table(schemas.conform(df, schema), path, "overwrite")
        return self.spark.read.schema(schema).parquet(path)

    def commit(self, batch_id: int, **facts) -> None:
        write_text(
            self.spark,
            f"{self.folder}/_commits/{batch_id:012d}.json",
            json.dumps({"batch_id": batch_id, **facts}, sort_keys=True),
        )

    def compact(self, table: str) -> bool:
        """Rewrite the committed rows of an appended table into one sorted folder and adopt it.

        Of the store only last writes stay. False if there is nothing new to compact. A run that is
        lost before the record is written leaves a folder that no reader opens; of two runs at once
        the record of the later one counts, and both folders hold the same rows. Not to be run
        beside ``drop_replaced``.
        """
        if table not in APPENDED:
            raise ValueError(f"{table} is replaced by each batch, there is nothing to compact")
        done = self.commits()
        if not done or self._compacted(table) == done[-1]:
            return False
        rows = self.store() if table == "store" else self.read(table)
        folder = f"compact-{done[-1]}-{uuid.uuid4().hex}"
        keys = SORTED[table]
        write_table(rows.repartitionByRange(*keys).sortWithinPartitions(*keys), f"{self.folder}/{table}/{folder}")
        write_text(
            self.spark,
            f"{self.folder}/_compactions/{table}/{done[-1]:012d}.json",
            json.dumps({"folder": folder, "through": done[-1]}, sort_keys=True),
        )
        return True

    def drop_replaced(self, table: str) -> list[str]:
        """Delete the folders that a compacted one stands for; their names.

        For a time when no reader that opened the table before the compaction is still at work.
        Batches that are not committed are left alone: one of them may be running.
        """
        through = self._compacted(table)
        if through is None:
            return []
        live = {folder.rsplit("/", 1)[1] for folder in self.live_folders(table)}
        done = {f"batch={b}" for b in self.commits() if b <= through}
        names = list_names(self.spark, f"{self.folder}/{table}")
        gone = [n for n in names if n not in live and (n in done or n.startswith("compact-"))]
        for name in gone:
            delete(self.spark, f"{self.folder}/{table}/{name}")
        return gone

    def spectrum(self, path: str, scan: int) -> DataFrame:
        """The last write of one stored spectrum, or no row; the filter reaches the file scan."""
        return latest(self.read("store").where((F.col("path") == path) & (F.col("scan") == scan)), ["batch_id"])

    def representative(self, cluster_id: int) -> DataFrame:
        """The representative of one cluster, or no row."""
        return point(self.read("consensus"), cluster_id=cluster_id)

    def current_consensus(self) -> DataFrame:
        """Representatives of clusters that the scan list holds."""
        return self.read("consensus").join(
            self.read("scan_list").select("cluster_id").distinct(), "cluster_id", "left_semi"
        )
