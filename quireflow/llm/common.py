"""What the operators of this subpackage share: scratch tables in the shared folder, word rules, bucketed ranks and prefix sums."""

from __future__ import annotations

import ctypes
import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow import tables
from quireflow.tables import Tables, delete_path  # noqa: F401 - for the operators

#: A word is a run of characters other than these six.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


class Scratch(Tables):
    """Intermediate tables of one call. ``finish`` writes the result and deletes everything else; results, and tables that a lazy result still reads, stay until the process ends."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        super().__init__(spark, name)
        ship(spark)

    def finish(self, df: DataFrame) -> DataFrame:
        out = self.cut(df, "result")
        self.drop(*[n for n in list(self.held) if n != "result"])
        return out


_BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors. Rows here are whole documents, so Spark's default of 10,000 rows for an Arrow batch is lowered; a setting of the user's own stays."""
    if spark.conf.get(_BATCH_CONF) == "10000":
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))
    tables.ship(spark)


_KEPT: dict[str, object] = {}


def worker_kept(key: str, build):
    """A Python worker's cache of one thing at a time: workers are reused by later operators, and must not hold what earlier ones kept."""
    if key not in _KEPT:
        worker_forget()
        _KEPT[key] = build()
    return _KEPT[key]


def worker_forget() -> None:
    """Drops what this worker keeps and hands the memory back to the system."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
    worker_trim()


def worker_trim() -> None:
    """Hands freed memory back to the system: Arrow's pool does so itself, Python's where the C library can."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def small_batches(batches, rows: int = 512):
    """Arrow batches in slices of so many rows: what Python holds at once follows the slice, not Spark's batch size."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    worker_trim()


def n_words(text: Column) -> Column:
    """Number of words; null text has none. A space is put in front, so that a split at word starts gives one part more than words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def numbered(df: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """df with a long ``name`` that tells each row's place, the same whenever it is read again.

    Of a table as it lies in its files a row's partition and place in it are always the same. The rows of a shuffle may come
    in another order after an executor is lost, so such a frame is written first.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan or "Python" in plan or "Arrow" in plan or "ExistingRDD" in plan:
        df = scratch.cut(df, f"{name}-numbered")
    return df.withColumn(name, F.monotonically_increasing_id())


def row_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).collect()[0][0]


def bucket_totals(df: DataFrame, group: list[str], bucket: str, value: Column, name: str) -> DataFrame:
    """Sum of ``value`` over all earlier buckets of the same group: (group, bucket, name). Its rows are one for each group and bucket."""
    from pyspark.sql import Window

    sums = df.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*group, bucket, F.coalesce(F.sum("_sum").over(w), F.lit(0)).cast("long").alias(name))


def buckets_for(rows: int, per_bucket: int = 500_000, least: int = 64) -> int:
    """So many hash buckets that each holds about per_bucket rows at most, whatever the input's size."""
    return max(least, -(-rows // per_bucket))
