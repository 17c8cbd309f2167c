"""Written tables in the shared folder, and the package on the executors."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOTS: list[tuple[SparkSession, str]] = []
_SHIPPED = "quireflow-package.zip"


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or set by setCheckpointDir. Only on one machine, where neither is there, a new temporary folder, which is then set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="quireflow-"))
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return root


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration() if spark.sparkContext._jsc is not None else spark._jvm.org.apache.hadoop.conf.Configuration()
    p.getFileSystem(conf).delete(p, True)


def delete_roots() -> None:
    """Deletes what this process's calls have left in the shared folder, results included. Called when the process ends."""
    while _ROOTS:
        spark, root = _ROOTS.pop()
        try:
            delete_path(spark, root)
        except Exception:  # noqa: BLE001, S110 - the JVM may be gone already
            pass


atexit.register(delete_roots)


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, once a session, so that Python workers can import it wherever they run.

    A function takes the list of files along when it is made, so whatever makes one for the executors calls this before.
    """
    sc = spark.sparkContext
    if any(str(f).endswith(_SHIPPED) for f in sc._python_includes):
        return
    top = Path(__file__).resolve().parent
    where = Path(tempfile.mkdtemp(prefix="quireflow-ship-")) / _SHIPPED
    with zipfile.ZipFile(where, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, os.path.join(top.name, p.relative_to(top)))
    sc.addPyFile(str(where))


class Tables:
    """Intermediate tables of one call, as Parquet in the shared folder, so that a lost executor costs no recomputation beyond them, and what is read twice is computed once."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root, self.n = spark, f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}", 0
        self.held: dict[str, str] = {}
        _ROOTS.append((spark, self.root))
        ship(spark)

    def path(self, name: str) -> str:
        """A new path; a name that is taken gets its number too, so that no table is lost sight of."""
        self.n += 1
        key = name if name not in self.held else f"{name}-{self.n}"
        self.held[key] = f"{self.root}/{self.n:03d}-{name}"
        return self.held[key]

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Writes and rereads a frame."""
        path, schema = self.path(name), df.schema
        df.write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes tables that nothing reads any more."""
        for name in names:
            if name in self.held:
                delete_path(self.spark, self.held.pop(name))

    def close(self) -> None:
        """Deletes all of them."""
        self.held.clear()
        delete_path(self.spark, self.root)
        if (self.spark, self.root) in _ROOTS:
            _ROOTS.remove((self.spark, self.root))
