"""Token counts kept as additive totals by source, language and tokenizer version, maintained by signed deltas.

A batch brings changes: inserts, deletes and revised counts of documents. Each becomes at most two signed rows in a
ledger, minus what the ledger held for the document and plus what holds now. Totals are sums of signed rows, so a
batch only adds its own sums to them. Of the ledger only keys and counts of the documents that the batch touches are
moved and summed; no text is read again. ``compact`` replaces the history by one net row for each live document.

A batch counts once its record stands under ``_commits``. Records are numbered; each says on which one it builds, and
takes the next number only if nobody else has. It is written aside and renamed, so it is whole or not there. A batch
that is sent again changes nothing, a run that was lost half way and is repeated counts once, and of two batches at
once the slower one is worked out anew on what the faster one has left. This relies on a file system that does not
rename onto an existing file, as HDFS; a plain local folder only has a look right before the rename.

Totals are combined before the shuffle; a source with a third of all rows costs no more than others.

Defined cases: an insert of a known document and a revision of an unknown one both set its count; a delete of an
unknown one does nothing; of several changes to one document and tokenizer in a batch the last by ``seq`` counts, ties
by kind and then count; null keys are keys like others; a null count is 0; an empty batch is committed; extra columns
are not looked at.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.session import delete, list_names, read_text

KEY = ["doc_id", "tokenizer"]
GROUP = ["source", "lang", "tokenizer"]
KINDS = ("insert", "delete", "revise")
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Words of letters, digits and characters outside ASCII; 0 for null."""
    words = F.split(F.coalesce(text, F.lit("")), "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
    ends = (F.element_at(words, 1) == "").cast("int") + (F.element_at(words, -1) == "").cast("int")
    return F.when(F.size(words) == 1, 1 - (F.element_at(words, 1) == "").cast("int")).otherwise(F.size(words) - ends).cast("long")


def byte_count(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


class TokenRollup:
    """Ledger, totals and commit records under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _records(self) -> list[dict]:
        """The records in order: ``batch`` (null for a compaction) and ``folder``."""
        names = [n for n in list_names(self.spark, f"{self.path}/_commits") if n.endswith(".json")]
        return [json.loads(read_text(self.spark, f"{self.path}/_commits/{n}")) for n in names]

    def _read(self, kind: str, records: list[dict] | None = None) -> DataFrame | None:
        records = self._records() if records is None else records
        start = max((n for n, r in enumerate(records) if r["batch"] is None), default=0)
        folders = [f"{self.path}/{kind}/{r['folder']}" for r in records[start:]]
        return self.spark.read.parquet(*folders) if folders else None

    def live(self, touched: DataFrame | None = None, records: list[dict] | None = None) -> DataFrame | None:
        """What the ledger holds, of all documents or of the ``touched`` keys: doc_id, tokenizer, source, lang, tokens."""
        ledger = self._read("ledger", records)
        if ledger is None:
            return None
        if touched is not None:
            keys = touched.select(*[F.col(k).alias(f"_{k}") for k in KEY])
            ledger = ledger.join(keys, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY], "left_semi")
        held = ledger.groupBy(*KEY, "source", "lang").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return held.where(F.col("docs") > 0).drop("docs")

    def totals(self, records: list[dict] | None = None) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of all committed batches; groups without documents are left out."""
        sums = self._read("totals", records)
        if sums is None:
            schema = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
            return self.spark.createDataFrame([], schema)
        added = sums.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return added.where((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))

    def _signed(self, changes: DataFrame, records: list[dict]) -> DataFrame:
        order = F.struct("seq", "change", "tokens", "source", "lang")
        last = changes.withColumn("tokens", F.coalesce("tokens", F.lit(0)).cast("long"))
        last = last.groupBy(*KEY).agg(F.max(order).alias("last")).select(*KEY, "last.*")
        plus = last.where(F.col("change") != "delete").select(*KEY, "source", "lang", F.lit(1).cast("long").alias("docs"), "tokens")
        minus = self.live(last, records)
        if minus is None:
            return plus
        minus = minus.select(*KEY, "source", "lang", F.lit(-1).cast("long").alias("docs"), (-F.col("tokens")).alias("tokens"))
        return plus.unionAll(minus)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of changes (doc_id, tokenizer, source, lang, change, tokens, seq); False if it counts already."""
        wrong = changes.where(F.col("change").isNull() | ~F.col("change").isin(*KINDS)).limit(1).count()
        if wrong:
            raise ValueError(f"changes must be one of {KINDS}")
        while True:  # once, and again for each batch that came in between
            records = self._records()
            if any(r["batch"] == batch for r in records):
                return False
            folder = f"{quote(batch, safe='')}-{uuid.uuid4().hex}"
            self._signed(changes, records).write.parquet(f"{self.path}/ledger/{folder}")
            signed = self.spark.read.parquet(f"{self.path}/ledger/{folder}")
            sums = signed.groupBy(*GROUP).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
            sums.write.parquet(f"{self.path}/totals/{folder}")  # one row a group, small partitions are merged by re-planning
            if self._record(len(records), {"batch": batch, "folder": folder}):
                return True
            self._drop(folder)

    def compact(self) -> bool:
        """One net ledger row for each live document and one total for each group in place of the history.

        Records of batches stay, so a batch that is sent again is still known. False, and nothing done, if there is
        no history or a batch came in between.
        """
        records = self._records()
        if not records or records[-1]["batch"] is None:
            return False
        folder = f"net-{uuid.uuid4().hex}"
        net = self.live(records=records).withColumn("docs", F.lit(1).cast("long"))
        net.select(*KEY, "source", "lang", "docs", "tokens").write.parquet(f"{self.path}/ledger/{folder}")
        self.totals(records).write.parquet(f"{self.path}/totals/{folder}")
        if self._record(len(records), {"batch": None, "folder": folder}):
            return True
        self._drop(folder)
        return False

    def _drop(self, folder: str) -> None:
        for kind in ("ledger", "totals"):
            delete(self.spark, f"{self.path}/{kind}/{folder}")

    def _record(self, number: int, facts: dict) -> bool:
        """Take the number for this record; False if another one has it."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_commits/{number:012d}.json")
        side = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_commits/.{uuid.uuid4().hex}")
        system = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        stream = system.create(side, False)
        try:
            stream.write(json.dumps(facts).encode())
        finally:
            stream.close()
        if not system.exists(path) and system.rename(side, path):
            return True
        system.delete(side, False)
        return False


def counts(docs: DataFrame, tokenizers: dict[str, Column], change: str = "insert", seq: int = 0) -> DataFrame:
    """Changes for ``docs`` (doc_id, source, lang): one row for each tokenizer and its count column."""
    pairs = F.array(*[F.struct(F.lit(n).alias("tokenizer"), c.cast("long").alias("tokens")) for n, c in tokenizers.items()])
    rows = docs.select("doc_id", "source", "lang", F.explode(pairs).alias("p"))
    return rows.select("doc_id", "p.tokenizer", "source", "lang", F.lit(change).alias("change"), "p.tokens", F.lit(seq).alias("seq"))
