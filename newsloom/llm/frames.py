"""Small Spark helpers of the operators: tables in the shared folder, column picks, batch maps."""

from __future__ import annotations

import contextlib
import contextvars
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_ROWS = 1000


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local master, whose one machine is the whole cluster, may do without the setting."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = "/tmp/newsloom-checkpoints"
    return where.rstrip("/")


def _path(spark: SparkSession, path: str):
    """(file system, path) of a stored table."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


# The lists that note what is stored, by thread: queries that run side by side don't see each other's tables.
_records: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("records", default=())


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet in the shared folder and read it again: cuts lineage, survives lost executors.

    What is still there when the application ends is deleted then.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for record in _records.get():
        record.append(path)
    df.write.option("compression", "zstd").parquet(path)
    system, at = _path(spark, path)
    system.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


@contextlib.contextmanager
def recorded():
    """A list that gets the path of every table this thread stores within."""
    paths: list[str] = []
    token = _records.set((*_records.get(), paths))
    try:
        yield paths
    finally:
        _records.reset(token)


def delete(spark: SparkSession, paths: list[str], keep: tuple[DataFrame, ...] = ()) -> None:
    """Delete stored tables that nothing reads any more; the frames to keep are those that stored() gave."""
    needed = {df.stored_at for df in keep}
    for p in paths:
        if p not in needed:
            system, at = _path(spark, p)
            system.delete(at, True)


def texts(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, under those names; other columns, whatever their names, go.

    Texts may be long, so the session's Arrow batches hold fewer rows from here on.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df.select(*columns)


def batches(df: DataFrame, fn, schema: str, setup=None) -> DataFrame:
    """mapInArrow; fn takes one record batch (and what setup() made, once a task) and yields record batches."""

    def run(it):
        made = (setup(),) if setup else ()
        for batch in it:
            if batch.num_rows:
                yield from fn(batch, *made)

    return df.mapInArrow(run, schema)


def runs(it, n_keys):
    """A table for each run of rows equal in the first n_keys columns, over a stream of record batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in it:
        if not batch.num_rows:
            continue
        keys = np.stack([np.asarray(batch.column(k)) for k in range(n_keys)], 1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(keys[lo].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that the frame does not have yet."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def settled(df: DataFrame, **columns) -> DataFrame:
    """The frame with these columns computed once a row: a lambda over them would else work them out for each element."""
    return df.select("*", F.inline(F.array(F.struct(*[e.alias(c) for c, e in columns.items()]))))
