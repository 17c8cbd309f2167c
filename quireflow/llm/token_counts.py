"""Token counts as delta-maintained rollups.

A store keeps signed sums of documents and tokens by (source, lang, tokenizer, version). A batch of changes (insert, delete,
revise) is reduced to one delta per group and committed under its id; totals are the sum of the committed deltas. A revision
takes a document's old count from its old group and puts its new count into its new one, which may be another. The commit
point is a log entry that is created only if it is not there yet, so a batch that is sent twice, or whose job is retried
after it had been committed, changes nothing. An entry names its own batch and folder only; every STATE_EVERY-th holds the
whole state, so a reader opens that many at most. ``compact`` puts one folder in place of many, ``vacuum`` deletes what no
entry needs any more.

Entries are put in place by a rename that fails if the name is taken: HDFS and local file systems do that, object stores
don't, so paths there are refused.

Defined cases: null source, lang, tokenizer or version are groups of their own; a null count is 0; an unknown op raises;
repeated rows count each; an empty batch is committed and changes nothing. Extra columns are ignored. In ``count_tokens`` a
null or empty text has no tokens.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.llm.common import delete_path, ship
from quireflow.llm.tokens import encoders

GROUP = ["source", "lang", "tokenizer", "version"]
SCHEMA = ", ".join(f"{g} string" for g in GROUP) + ", docs long, tokens long"
STATE_EVERY = 64
#: Schemes of object stores, whose rename replaces what is there.
REPLACING = ["s3", "s3a", "s3n", "gs", "abfs", "abfss", "wasb", "wasbs", "oss", "cosn"]


def refuse_replacing(scheme: str) -> None:
    if scheme in REPLACING:
        raise ValueError("a store needs a file system whose rename does not replace files")


class RollupStore:
    """Rollups under ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        ship(spark)
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._at = lambda name: hadoop.Path(f"{path}/{name}")
        self._fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        refuse_replacing(self._fs.getUri().getScheme())

    def _names(self) -> list[str]:
        folder = self._at("log")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(folder)) if self._fs.exists(folder) else []

    def _read(self, name: str) -> dict:
        stream = self._fs.open(self._at(f"log/{name}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _state(self) -> tuple[int, list[str], list[str]]:
        """The newest version, live folders, and ids of committed batches."""
        names, later = self._names(), []
        folders: list[str] = []
        ids: list[str] = []
        for name in reversed(names):
            entry = self._read(name)
            if "state" in entry:
                folders, ids = list(entry["state"]["folders"]), list(entry["state"]["ids"])
                break
            later.append(entry)
        for entry in reversed(later):
            folders.append(entry["folder"])
            ids.append(entry["id"])
        return int(names[-1].split(".")[0]) if names else -1, folders, ids

    def _append(self, version: int, entry: dict) -> bool:
        """Creates the entry under a hidden name first, so that no reader sees half of it; false if another writer was faster."""
        final = self._at(f"log/{version:012d}.json")
        if self._fs.exists(final):
            return False
        hidden = self._at(f"tmp-{uuid.uuid4().hex}")
        stream = self._fs.create(hidden, False)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        self._fs.mkdirs(self._at("log"))
        done = self._fs.rename(hidden, final)
        if not done:
            self._fs.delete(hidden, False)
        return done

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Adds a batch: op, source, lang, tokenizer, version, n_tokens and, for revise, old_n_tokens. False if that id is committed already.

        Columns old_source, old_lang, old_tokenizer and old_version, where they are there, tell a revised row's old group;
        else it is the new one.
        """
        if batch_id in self._state()[2]:
            return False
        n = F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long")
        old = F.coalesce(F.col("old_n_tokens") if "old_n_tokens" in changes.columns else F.lit(0), F.lit(0)).cast("long")
        now = [F.col(g).cast("string").alias(g) for g in GROUP]
        was = [F.col(f"old_{g}" if f"old_{g}" in changes.columns else g).cast("string").alias(g) for g in GROUP]
        delta = lambda group, docs, tokens: F.struct(*group, F.lit(docs).cast("long").alias("docs"), tokens.alias("tokens"))
        unknown = F.raise_error(F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("null"))))
        each = F.when(F.col("op") == "insert", F.array(delta(now, 1, n))).when(F.col("op") == "delete", F.array(delta(now, -1, -n)))
        each = each.when(F.col("op") == "revise", F.array(delta(was, -1, -old), delta(now, 1, n))).otherwise(F.array(delta(now, 1, unknown.cast("long"))))
        folder = f"data/{uuid.uuid4().hex}"
        deltas = changes.select(F.explode(each).alias("d")).select("d.*").groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        deltas.where("docs <> 0 OR tokens <> 0").write.parquet(f"{self.path}/{folder}")
        while True:
            version, folders, ids = self._state()
            if batch_id in ids:
                delete_path(self.spark, f"{self.path}/{folder}")
                return False
            entry: dict = {"id": batch_id, "folder": folder}
            if (version + 1) % STATE_EVERY == 0:
                entry["state"] = {"folders": [*folders, folder], "ids": [*ids, batch_id]}
            if self._append(version + 1, entry):
                return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, version, docs, tokens: the sum of all committed deltas, without groups that are empty again."""
        folders = [f"{self.path}/{f}" for f in self._state()[1]]
        df = self.spark.read.schema(SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], SCHEMA)
        return df.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 OR tokens <> 0")

    def compact(self) -> bool:
        """Puts the totals in place of the deltas they sum up; false if a batch was committed meanwhile. Readers of older entries need the folders, which stay until ``vacuum``."""
        version, _, ids = self._state()
        folder = f"data/{uuid.uuid4().hex}"
        self.totals().write.parquet(f"{self.path}/{folder}")
        done = self._append(version + 1, {"id": None, "folder": folder, "state": {"folders": [folder], "ids": ids}})
        if not done:
            delete_path(self.spark, f"{self.path}/{folder}")
        return done

    def vacuum(self, older_than_s: float = 86_400) -> int:
        """Deletes data folders that the newest state doesn't name and entries before the last whole state, if they are older than that; so many of them."""
        _, folders, _ = self._state()
        names, gone, limit = self._names(), 0, 1000 * (time.time() - older_than_s)
        whole = max((k for k, n in enumerate(names) if "state" in self._read(n)), default=0)
        old = [self._at(f"log/{n}") for n in names[:whole]]
        if self._fs.exists(self._at("data")):
            old += [s.getPath() for s in self._fs.listStatus(self._at("data")) if f"data/{s.getPath().getName()}" not in folders]
        for p in old:
            if self._fs.getFileStatus(p).getModificationTime() <= limit:
                gone += self._fs.delete(p, True)
        return gone


def version_of(vocabulary: str) -> str:
    """A vocabulary's version: the CRC of its file, as eight hex digits."""
    return f"{zlib.crc32(Path(vocabulary).read_bytes()):08x}"


def count_tokens(docs: DataFrame, tokenizers: list[tuple[str, str, str]]) -> DataFrame:
    """docs with ``counts``: an array of (tokenizer, version, n_tokens), one for each (name, kind, vocabulary file). All are counted in one pass over the texts."""
    ship(docs.sparkSession)
    versions = [version_of(path) for _, _, path in tokenizers]
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))

    @F.pandas_udf("array<long>")
    def count(texts):
        import pandas as pd

        own = [e.count for e in encoders([(path, kind) for _, kind, path in tokenizers])]
        return pd.Series([[one(t) for one in own] for t in texts])

    each = [F.struct(F.lit(name).alias("tokenizer"), F.lit(v).alias("version"), F.get("n", F.lit(k)).alias("n_tokens")) for k, ((name, _, _), v) in enumerate(zip(tokenizers, versions, strict=True))]
    counted = whole.withColumn("n", count.asNondeterministic()(F.col("doc.text").cast("string")))
    return counted.select(*(F.col(f"doc.`{c}`") for c in docs.columns if c != "counts"), F.array(*each).alias("counts"))
