"""Partitioned tables that are replaced part by part and all at once.

New files of a write go beside the old ones, as a generation of their own; a small list says which generation holds each
partition, and readers follow the newest finished list.  A write that dies before its list is finished has changed
nothing.  One list back is kept for readers that have just begun, and so are the files it names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import drop_folder, exists, folders

LIST = "part STRING, gen BIGINT"


class Generations:
    """A table under `path`, partitioned by `columns`."""

    def __init__(self, spark: SparkSession, path: str, columns: list[str]):
        self.spark, self.path, self.columns = spark, path.rstrip("/"), columns

    def _lists(self) -> list[int]:
        return [n for n in folders(self.spark, f"{self.path}/list", "v=")
                if exists(self.spark, f"{self.path}/list/v={n}/_SUCCESS")]

    def _at(self, version: int) -> dict[str, int]:
        rows = self.spark.read.schema(LIST).json(f"{self.path}/list/v={version}")
        return {r.part: r.gen for r in rows.collect()}  # one entry per partition of the table

    def current(self) -> dict[str, int]:
        """Generation of each partition."""
        versions = self._lists()
        return self._at(versions[-1]) if versions else {}

    def read(self, schema: str, parts: list[str] | None = None) -> DataFrame:
        """The rows of the table, or of some partitions; `schema` names all columns."""
        listed = self.current()
        wanted = [p for p in listed if parts is None or p in set(parts)]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(f"{schema}, gen BIGINT").option("basePath", f"{self.path}/data").parquet(
            *[f"{self.path}/data/gen={listed[p]}/{p}" for p in wanted]).drop("gen")

    def parts_of(self, rows: DataFrame) -> list[str]:
        """Folders of the partitions that rows fall into, as Spark names them: at most as many as the table has."""
        name = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        values = rows.select(*[F.col(c).cast("string").alias(c) for c in self.columns]).distinct().collect()
        return ["/".join(name(c, row[c]) for c in self.columns) for row in values]

    def replace(self, rows: DataFrame, touched: list[str]) -> None:
        """Put the rows in place of the touched partitions; one that gets no rows is gone."""
        listed, versions = self.current(), folders(self.spark, f"{self.path}/list", "v=")
        gen = max([-1, *folders(self.spark, f"{self.path}/data", "gen=")]) + 1
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*self.columns).parquet(
            f"{self.path}/data/gen={gen}")
        new = self.parts_of(self.spark.read.schema(rows.schema).parquet(f"{self.path}/data/gen={gen}"))
        after = {p: g for p, g in listed.items() if p not in set(touched)} | {p: gen for p in new}
        version = max([-1, *versions]) + 1
        self.spark.createDataFrame(list(after.items()), LIST).coalesce(1).write.mode("overwrite").json(
            f"{self.path}/list/v={version}")
        self._tidy(listed)

    def _tidy(self, before: dict[str, int]) -> None:
        """Drop lists older than the one before, and generations that neither it nor the new one names."""
        done = self._lists()
        named = set(before.values()) | set(self._at(done[-1]).values())
        for v in folders(self.spark, f"{self.path}/list", "v="):
            if v not in done[-2:]:
                drop_folder(self.spark, f"{self.path}/list/v={v}")
        for gen in folders(self.spark, f"{self.path}/data", "gen="):
            if gen not in named:
                drop_folder(self.spark, f"{self.path}/data/gen={gen}")
