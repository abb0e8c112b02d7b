"""Tables dealt into parts by a hash, in versions: a batch reads and writes only the parts it touches.

`versions/n` lists, after batch n, the version of each part of each table, and is written last: a batch that
stops halfway leaves everything as it was, and one that runs again writes the same. A part that a batch
leaves without rows is listed no more. Parts that neither this list nor the one before it names are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LISTED = "name string, part long, version long"


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _path(spark, path)
    return system.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    system, at = _path(spark, path)
    system.delete(at, True)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder over what an earlier try has left there; false if there is no such folder, an error if it can't be moved."""
    system, at = _path(spark, source)
    if not system.exists(at):
        return False
    _, to = _path(spark, target)
    system.delete(to, True)
    system.mkdirs(to.getParent())
    if not system.rename(at, to):
        raise OSError(f"{source} could not be renamed to {target}")
    return True


class Parts:
    """The tables below one path after batch `number - 1`, and what batch `number` makes of them."""

    def __init__(self, spark: SparkSession, path: str, number: int, count: int):
        self.spark, self.path, self.number, self.count = spark, path, number, count
        if number and not exists(spark, f"{path}/versions/{number - 1}"):
            raise FileNotFoundError(f"batch {number} needs the version before it, {path}/versions/{number - 1}")
        self.before = listed(spark, path, number - 1)
        self.now = dict(self.before)

    def place(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.count)).cast("long")

    def touched(self, rows: DataFrame, key: Column) -> list[int]:
        """The parts that rows fall into: `count` numbers at most."""
        return sorted(r[0] for r in rows.select(self.place(key).alias("p")).distinct().collect())

    def read(self, name: str, schema, parts: list[int] | None = None, new: bool = False) -> DataFrame:
        """A table as it was before the batch, or as the batch has it by now; all parts or some."""
        return _read(self.spark, self.path, self.now if new else self.before, name, schema, parts)

    def write(self, name: str, rows: DataFrame, key: Column, parts: list[int]) -> None:
        """New versions of these parts; rows hold all that is to be in them."""
        made = f"{self.path}/new/{name}"
        rows.withColumn("_part", self.place(key)).repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(made)
        for p in parts:
            if move(self.spark, f"{made}/_part={p}", f"{self.path}/{name}/{p}/v{self.number}"):
                self.now[name, p] = self.number
            else:
                self.now.pop((name, p), None)

    def commit(self) -> None:
        rows = [(n, p, v) for (n, p), v in sorted(self.now.items())]
        self.spark.createDataFrame(rows, LISTED).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/{self.number}")
        delete(self.spark, f"{self.path}/new")
        older = f"{self.path}/versions/{self.number - 2}"
        if self.number >= 2 and exists(self.spark, older):
            for (n, p), v in listed(self.spark, self.path, self.number - 2).items():
                if self.before.get((n, p)) != v:
                    delete(self.spark, f"{self.path}/{n}/{p}/v{v}")
            delete(self.spark, older)


def listed(spark: SparkSession, path: str, number: int) -> dict[tuple[str, int], int]:
    """The version of each part after batch `number`: a row a part."""
    return {} if number < 0 else {(r["name"], r["part"]): r["version"] for r in spark.read.schema(LISTED).parquet(f"{path}/versions/{number}").collect()}


def _read(spark, path, versions, name, schema, parts=None) -> DataFrame:
    folders = [f"{path}/{n}/{p}/v{v}" for (n, p), v in sorted(versions.items()) if n == name and (parts is None or p in parts)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_version(spark: SparkSession, path: str, number: int, name: str, schema) -> DataFrame:
    """A table after batch `number`."""
    return _read(spark, path, listed(spark, path, number), name, schema)
