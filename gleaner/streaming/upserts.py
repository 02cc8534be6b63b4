"""A note table fed by a stream: each micro-batch appends what it changed, readers take the newest row of every note.

Under the table's folder, `delta/batch=N` holds the whole rows that batch N wrote and the ids it took away.  Every
`fold_every` batches the deltas are folded into `base/upto=N`, laid out by a hash of the url, with a slim table of
(slug, note id, place) laid out by a hash of the slug.  A batch looks up its urls and slugs in those places only, and what
it writes grows with the batch.  A folder counts once Spark has marked it as written, so a batch that died runs again from
the same state and replaces its own delta.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from gleaner.functions.text import slug_suffix_title, slugify
from gleaner.functions.urls import with_normalised_url
from gleaner.operators.store import upsert_changes
from gleaner.schemas import NOTES
from gleaner.session import drop_folder, exists, folders
from gleaner.vocabulary import TAGS, TagVocabulary

Step = Callable[[DataFrame, int], None]

#: batches between two folds, and notes that a place of the base should hold
FOLD_EVERY, PLACE_ROWS = 16, 250_000
DELTA = f"{NOTES}, gone BOOLEAN"
SLUGS = "slug STRING, note_id STRING, at INT, place INT"


def place_of(places: int | Column, key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(places) if isinstance(places, int) else places).cast("int")


def _url_key() -> Column:
    """Notes without a url are placed by their id."""
    return F.coalesce(F.nullif("source_url", F.lit("")), "note_id")


class NoteTable:
    """The folder of a streamed note table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _written(self, kind: str, prefix: str) -> list[int]:
        return [n for n in folders(self.spark, f"{self.path}/{kind}", f"{prefix}=")
                if exists(self.spark, f"{self.path}/{kind}/{prefix}={n}/_SUCCESS")
                or exists(self.spark, f"{self.path}/{kind}/{prefix}={n}/places/_SUCCESS")]

    def parts(self, before: int | None = None) -> tuple[int | None, list[int]]:
        """The newest base and the deltas after it, of the batches before `before`."""
        seen = [n for n in self._written("base", "upto") if before is None or n < before]
        base = seen[-1] if seen else None
        return base, [n for n in self._written("delta", "batch")
                      if (before is None or n < before) and (base is None or n > base)]

    def deltas(self, batches: list[int]) -> DataFrame:
        """Rows of these deltas with their batch; none for no deltas."""
        schema = f"{DELTA}, batch BIGINT"
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/delta").parquet(
            *[f"{self.path}/delta/batch={n}" for n in batches])

    def base(self, upto: int | None) -> DataFrame:
        """Notes of a base with their place."""
        if upto is None:
            return self.spark.createDataFrame([], f"{NOTES}, place INT")
        return self.spark.read.schema(f"{NOTES}, place INT").parquet(f"{self.path}/base/upto={upto}/notes")

    def slugs(self, upto: int | None) -> DataFrame:
        if upto is None:
            return self.spark.createDataFrame([], SLUGS)
        return self.spark.read.schema(SLUGS).parquet(f"{self.path}/base/upto={upto}/slugs")

    def places(self, upto: int | None) -> int:
        if upto is None:
            return 1
        return self.spark.read.schema("n INT").parquet(f"{self.path}/base/upto={upto}/places").first().n

    def newest(self, deltas: DataFrame) -> DataFrame:
        """The newest row of every note that the deltas know."""
        whole = F.struct(*[c for c in deltas.columns if c != "batch"])
        return deltas.groupBy("note_id").agg(F.max_by(whole, "batch").alias("row")).select("row.*")

    def read(self, before: int | None = None) -> DataFrame:
        """All notes as they stand (before a batch)."""
        upto, batches = self.parts(before)
        return self._standing(self.base(upto).drop("place"), self.deltas(batches))

    def _standing(self, base: DataFrame, deltas: DataFrame) -> DataFrame:
        kept = base.join(deltas.select("note_id"), "note_id", "left_anti")
        return kept.unionByName(self.newest(deltas).where(~F.col("gone")).drop("gone"))

    def holding(self, urls: DataFrame, slugs: DataFrame, before: int) -> DataFrame:
        """The notes that hold any of the urls (source_url) or slugs (slug), as they stood before a batch.

        In the base only the places those hash to are read: joins on the partition column prune it.  Of the base and of
        the deltas, at most `fold_every` batches of changes, ids are looked up first and whole rows taken for those alone.
        """
        upto, batches = self.parts(before)
        deltas, places = self.deltas(batches), self.places(upto)
        near = urls.select("source_url", place_of(places, F.col("source_url")).alias("place"))
        listed = self.slugs(upto).join(
            slugs.select("slug", place_of(places, F.col("slug")).alias("place")), ["slug", "place"], "left_semi")
        base = self.base(upto)
        found = base.select("note_id", "source_url", "place").join(near, ["source_url", "place"], "left_semi") \
            .select("note_id", "place").unionByName(listed.select("note_id", F.col("at").alias("place")))
        ids = deltas.join(urls, "source_url", "left_semi").select("note_id").unionByName(
            deltas.join(slugs, "slug", "left_semi").select("note_id")).unionByName(found.select("note_id")).distinct()
        changed = self.newest(deltas.join(ids, "note_id", "left_semi"))
        stored = found.join(deltas.select("note_id"), "note_id", "left_anti")
        kept = base.join(stored, ["note_id", "place"], "left_semi").drop("place")
        return kept.unionByName(changed.where(~F.col("gone")).drop("gone"))

    def append(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/delta/batch={batch_id}")

    def fold(self, batch_id: int) -> None:
        """Fold everything up to a batch into a new base, then drop what the base before no longer needs."""
        older, _ = self.parts(batch_id)
        upto, batches = self.parts()
        # notes are counted by their ids, so that their content is moved for the base alone
        count = self._standing(self.base(upto).select("note_id"), self.deltas(batches).select("note_id", "gone", "batch")).count()
        self.lay_base(self.read(), count, batch_id)
        # a batch that runs again may still need the base before and what came after it
        if older is not None:
            for n in folders(self.spark, f"{self.path}/delta"):
                if n <= older:
                    drop_folder(self.spark, f"{self.path}/delta/batch={n}")
            for n in folders(self.spark, f"{self.path}/base", "upto="):
                if n < older:
                    drop_folder(self.spark, f"{self.path}/base/upto={n}")

    def lay_base(self, notes: DataFrame, count: int, batch_id: int) -> None:
        """Write so many notes as the base of everything up to a batch."""
        target = f"{self.path}/base/upto={batch_id}"
        places = max(-(-count // PLACE_ROWS), 1)
        notes = notes.withColumn("place", place_of(places, _url_key()))
        notes.repartition("place").write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("place").parquet(f"{target}/notes")
        written = self.spark.read.schema(f"{NOTES}, place INT").parquet(f"{target}/notes")
        written.where("slug is not null").select(
            "slug", "note_id", F.col("place").alias("at"), place_of(places, F.col("slug")).alias("place")
        ).repartition("place").write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("place").parquet(f"{target}/slugs")
        self.spark.range(1).select(F.lit(places).alias("n")).write.mode("overwrite").parquet(f"{target}/places")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The streamed note table; empty before the first batch."""
    return NoteTable(spark, path).read()


def seed(notes: DataFrame, path: str) -> None:
    """Begin a streamed table with the notes of a store."""
    rows = with_normalised_url(notes, "source_url", "source_url").dropDuplicates(["note_id"])
    table = NoteTable(notes.sparkSession, path)
    table.lay_base(rows.select(*table.base(None).drop("place").columns), notes.select("note_id").distinct().count(), -1)


def upsert_step(path: str, fold_every: int = FOLD_EVERY, vocab: TagVocabulary = TAGS,
                content_limit: int | None = None) -> Step:
    """Merge each micro-batch of incoming rows into the note table under `path`; `read_store` reads it.

    Write results go to `results/batch=N`.  A batch that runs again reads the table as it stood before it, so its delta
    and its results come out the same and are replaced.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        table = NoteTable(batch.sparkSession, path)
        incoming = with_normalised_url(batch, "source_url", "source_url")
        urls = incoming.where(F.coalesce("source_url", F.lit("")) != "").select("source_url").distinct()
        retried = slugify(slug_suffix_title(F.col("title"), F.col("source_url")))
        slugs = incoming.select(F.explode(F.array(slugify(F.col("title")), retried)).alias("slug")).distinct()
        known = table.holding(urls, slugs, batch_id).checkpoint()
        written, gone, results = upsert_changes(known, incoming, vocab=vocab, content_limit=content_limit)
        changed = written.withColumn("gone", F.lit(False)).unionByName(
            gone.withColumn("gone", F.lit(True)), allowMissingColumns=True)
        names = [f.name for f in table.deltas([]).schema if f.name != "batch"]
        table.append(changed.select(*names), batch_id)
        results.write.mode("overwrite").parquet(f"{table.path}/results/batch={batch_id}")
        if len(table.parts()[1]) >= fold_every:
            table.fold(batch_id)

    return step


def run_unless_open(writer: DataStreamWriter, is_open: Callable[[], bool], spark: SparkSession, runs_path: str,
                    profile: str, kind: str = "scheduled") -> bool:
    """Drain a stream once, unless the breaker is open: then only a skipped run is recorded.

    Nothing is read while the breaker is open, so the rows wait in the source and the next run that gets through takes
    them; the stream's own checkpoint knows how far it came.  Tells whether the stream ran.
    """
    if is_open():
        now = datetime.now(timezone.utc)
        row = [(f"skip-{profile}-{int(now.timestamp() * 1e6)}", profile, kind, "skipped", now.isoformat(), now.isoformat(),
                "circuit breaker open")]
        spark.createDataFrame(row, "run_id STRING, profile STRING, kind STRING, status STRING, started_at STRING, "
                                   "completed_at STRING, error STRING").write.mode("append").json(runs_path)
        return False
    writer.trigger(availableNow=True).start().awaitTermination()
    return True
