"""A keyed table that streams write batch by batch, kept small by merging in levels.

Each batch writes one run: its rows reduced to one per key, in folders by bucket (a hash of the key).  As soon as
``FAN`` runs of a level are there, they are merged into one run of the next level, as digits carry in counting:
before batch n the runs to read are the digits of n to the base ``FAN``.  So

* the runs to read are known from the batch's number alone, there is no list that could be out of step;
* a batch reads at most ``(FAN - 1) * levels`` runs, of these only the buckets of its own keys, however many
  batches there have been; each row is merged again only once per level;
* a batch that runs again replaces its own run and makes the same merges again.

Streams are told apart by the id of their checkpoint.  A stream that starts anew reads what earlier ones have left.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FAN = 8
BUCKETS = 64


class MergedTable:
    """``key`` and columns, each with the aggregate that merges two rows of a key (``values``: name, type and function)."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key: Sequence[str],
        values: dict[str, tuple[str, str]],
        fan: int = FAN,
        buckets: int = BUCKETS,
    ):
        if fan < 2 or buckets < 1:
            raise ValueError("needs a fan of two or more and a bucket")
        self.spark, self.root, self.fan, self.buckets = spark, root.rstrip("/"), fan, buckets
        self.key, self.values = list(key), values
        self.schema = ", ".join([*[f"`{c}` STRING" for c in self.key], *[f"`{c}` {kind}" for c, (kind, _) in values.items()], "__bucket INT"])

    # --- folders ------------------------------------------------------------------------

    def _folder(self, run: str, level: int, first: int) -> str:
        return f"{self.root}/run={run}/level={level}/first={first}"

    def _system(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, folder: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)

    def _names(self, folder: str, prefix: str) -> list[str]:
        """Names of the sub-folders ``prefix``name: runs, levels and their batches, a few dozen at most."""
        system, path = self._system(), self._path(folder)
        if not system.exists(path):
            return []
        names = [one.getPath().getName() for one in system.listStatus(path)]
        return [name.removeprefix(prefix) for name in names if name.startswith(prefix)]

    def live(self, batches: int) -> Iterator[tuple[int, int]]:
        """(level, first batch) of the runs that hold the first ``batches`` batches of a stream."""
        level, width = 0, 1
        while batches:
            digit = batches % self.fan
            batches //= self.fan
            for place in range(digit):
                yield level, (batches * self.fan + place) * width
            level, width = level + 1, width * self.fan

    def _written(self, run: str) -> int:
        """Number of batches that a stream has written."""
        return max((int(first) + 1 for first in self._names(f"{self.root}/run={run}/level=0", "first=")), default=0)

    def _check_sizes(self, make: bool = False) -> None:
        """The folder keeps the fan and the number of buckets, on which the names of its runs depend."""
        own = f"{self.fan}x{self.buckets}"
        kept = self._names(self.root, "sizes=")
        if kept and kept != [own]:
            raise ValueError(f"the table at {self.root} has fan and buckets {kept[0]}, not {own}")
        if make and not kept:
            self._system().mkdirs(self._path(f"{self.root}/sizes={own}"))

    def _folders(self, run: str | None, batch_id: int | None) -> list[str]:
        self._check_sizes()
        found = []
        for other in sorted(self._names(self.root, "run=")):
            count = batch_id if other == run and batch_id is not None else self._written(other)
            found += [self._folder(other, *one) for one in self.live(count)]
        return found

    # --- rows -----------------------------------------------------------------------------

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _reduced(self, rows: DataFrame) -> DataFrame:
        merged = [F.call_function(function, F.col(c)).alias(c) for c, (_, function) in self.values.items()]
        return rows.groupBy(*self.key).agg(*merged)

    def _read(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        # runs keep their buckets apart, so a condition on the bucket names the files to read
        parts = [self.spark.read.schema(self.schema.replace("__bucket", "bucket")).option("basePath", f).parquet(f) for f in folders]
        return reduce(DataFrame.unionAll, parts).withColumnRenamed("bucket", "__bucket")

    def read(self, run: str | None = None, batch_id: int | None = None) -> DataFrame:
        """The whole table, or as it was before a batch of a stream."""
        return self._reduced(self._read(self._folders(run, batch_id)))

    def lookup(self, keys: DataFrame, run: str | None = None, batch_id: int | None = None) -> DataFrame:
        """The rows of some keys, as they were before a batch of a stream: only the keys' buckets are read."""
        folders = self._folders(run, batch_id)
        wanted = keys.select(*self.key).distinct()
        # at most as many numbers as there are buckets
        buckets = [row[0] for row in wanted.select(self.bucket().alias("b")).distinct().collect()]
        rows = self._read(folders).where(F.col("__bucket").isin(buckets))
        return self._reduced(rows.join(wanted, self.key, "left_semi"))

    def _store(self, rows: DataFrame, folder: str) -> None:
        bucketed = self._reduced(rows).withColumn("bucket", self.bucket())
        bucketed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)

    def write(self, rows: DataFrame, run: str, batch_id: int) -> None:
        """Add the rows of a batch and merge the runs that are complete."""
        self._check_sizes(make=True)
        self._store(rows.select(*self.key, *self.values), self._folder(run, 0, batch_id))
        done, width, level = batch_id + 1, 1, 0
        while done % (width * self.fan) == 0:
            first = done - width * self.fan
            parts = [self._folder(run, level, first + place * width) for place in range(self.fan)]
            self._store(self._read(parts).drop("__bucket"), self._folder(run, level + 1, first))
            level, width = level + 1, width * self.fan
        self._forget(run, batch_id)

    def _forget(self, run: str, batch_id: int) -> None:
        """Remove runs that neither this batch, if it runs again, nor a later one reads.

        The newest run of level 0 stays, too: it tells how many batches there are.
        """
        needed = {*self.live(batch_id), *self.live(batch_id + 1), (0, batch_id)}
        # a merge that is made again reads its parts again
        needed |= {(0, first) for first in range(batch_id - batch_id % self.fan, batch_id + 1)}
        system = self._system()
        for level in map(int, self._names(f"{self.root}/run={run}", "level=")):
            for first in map(int, self._names(f"{self.root}/run={run}/level={level}", "first=")):
                if first < batch_id and (level, first) not in needed:
                    system.delete(self._path(self._folder(run, level, first)), True)
