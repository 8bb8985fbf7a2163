"""Compaction of streamed tables, by versioned manifests of their files.

A streaming job leaves a folder per batch; after months that is more folders than can be listed
for each query. ``compact`` rewrites the small files of committed batches as large ones and
publishes a manifest: the files the table has, and up to which batch of each job they go.
Readers take the newest manifest and the batches committed since. The manifest is one file and
written last, so a crash before that changes nothing, and files are never
changed or removed, so a reader of an older version goes on.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroflow.sinks.parquet import BATCH, FOLDERS, JOB, PAGE_ROWS, ParquetSink, _read_or_empty

VERSION = "version"
# A row is a data file with its bytes, or a job with the last batch the files hold.
MANIFEST = f"file string, bytes bigint, {JOB} string, {BATCH} bigint"
SMALL_FILE = 64 << 20

# Rows of a table that lie sorted next to each other, by table.
SORTED = {"flights": ["departure_iata", "flight_date"]}


@dataclass(frozen=True)
class Manifest:
    version: int
    files: tuple[tuple[str, int], ...]
    last_batch: dict[str, int]


NOTHING = Manifest(0, (), {})


@dataclass(frozen=True)
class CompactingSink(ParquetSink):
    """A Parquet sink whose small files can be rewritten while jobs append and readers read.

    One compaction of a table runs at a time; a second one that publishes the same version fails.
    """

    def _manifests(self, table: str) -> str:
        return f"{self.root}/_manifests/{table}"

    def _compacted(self, table: str) -> str:
        return f"{self.root}/_compacted/{table}"

    def manifest(self, spark: SparkSession, table: str, version: int | None = None) -> Manifest:
        """The newest manifest of a table, or the one of a version; version 0 is before the first."""
        every = _read_or_empty(spark, self._manifests(table), f"{MANIFEST}, {VERSION} int")
        newest = every.agg(F.max(VERSION)).first()[0] if version is None else version
        if not newest:
            return NOTHING
        rows = every.where(F.col(VERSION) == newest).collect()
        if not rows:
            raise ValueError(f"{table} has no version {newest}")
        files = tuple(sorted((r["file"], r["bytes"]) for r in rows if r["file"] is not None))
        return Manifest(newest, files, {r[JOB]: r[BATCH] for r in rows if r["file"] is None})

    def read(self, spark: SparkSession, table: str, ddl: str) -> DataFrame:
        """Rows of all committed batches: files of the newest manifest, and batches since."""
        manifest = self.manifest(spark, table)
        files = [file for file, _ in manifest.files]
        return self._rows(spark, table, ddl, files, self._batches_after(spark, table, manifest))

    def read_version(self, spark: SparkSession, table: str, ddl: str, version: int) -> DataFrame:
        """The rows a table had when a version was published."""
        files = [file for file, _ in self.manifest(spark, table, version).files]
        return self._rows(spark, table, ddl, files, [])

    def compact(
        self,
        spark: SparkSession,
        table: str,
        ddl: str,
        merge: Callable[[DataFrame], DataFrame] | None = None,
        small_file: int = SMALL_FILE,
    ) -> Manifest:
        """Rewrites files below ``small_file`` and all batches since the last version.

        ``merge`` may combine rows, such as partial sums of one key; it sees every row, as all files
        are rewritten then. Without new batches nothing is published.
        """
        before = self.manifest(spark, table)
        batches = self._batches_after(spark, table, before, empty_too=True)
        if not batches:
            return before
        kept = [(file, size) for file, size in before.files if merge is None and size >= small_file]
        small = [file for file, size in before.files if (file, size) not in kept]
        rows = self._rows(spark, table, ddl, small, [b for b in batches if b[2]])
        run = f"{self._compacted(table)}/run={uuid.uuid4().hex}"
        self._rewrite(table, merge(rows) if merge else rows, run)
        last = before.last_batch | {job: max(b for j, b, _ in batches if j == job) for job, _, _ in batches}
        return self._publish(spark, table, before.version + 1, kept + _files(spark, run), last)

    def _rewrite(self, table: str, rows: DataFrame, path: str) -> None:
        folder = FOLDERS.get(table)
        folder = folder if folder in rows.columns else None
        within = [c for c in SORTED.get(table, ()) if c in rows.columns]
        spread = rows.hint("rebalance", *([F.col(folder)] if folder else ()))
        if folder or within:
            spread = spread.sortWithinPartitions(*([folder] if folder else ()), *within)
        writer = spread.write.option("parquet.page.row.count.limit", PAGE_ROWS)
        (writer.partitionBy(folder) if folder else writer).parquet(path)

    def _publish(
        self, spark: SparkSession, table: str, version: int, files: Sequence[tuple[str, int]], last: dict[str, int]
    ) -> Manifest:
        rows = [(file, size, None, None) for file, size in files]
        rows += [(None, None, job, batch) for job, batch in last.items()]
        # One task writes one file, which appears when it is complete.
        whole = spark.createDataFrame(rows, MANIFEST).coalesce(1)
        whole.write.mode("errorifexists").parquet(f"{self._manifests(table)}/{VERSION}={version}")
        return Manifest(version, tuple(sorted(files)), last)

    def _batches_after(
        self, spark: SparkSession, table: str, manifest: Manifest, empty_too: bool = False
    ) -> list[tuple[str, int, bool]]:
        """Committed batches that the files do not hold: job, number, and whether the table has rows of it.

        Only names of audit folders are listed, and only those of new batches opened.
        """
        audits = f"{self.root}/{self.audit_table}"
        new = [
            f"{audits}/{JOB}={job}/{BATCH}={batch}"
            for job in _folders(spark, audits, JOB)
            for batch in map(int, _folders(spark, f"{audits}/{JOB}={job}", BATCH))
            if batch > manifest.last_batch.get(job, -1)
        ]
        if not new:
            return []
        entries = spark.read.schema(f"{table} bigint, {JOB} string, {BATCH} bigint").option("basePath", audits).parquet(*new)
        # Tables that are not counted themselves have rows whenever the batch had messages.
        rows = F.coalesce(F.sum(table), F.lit(1)) > 0
        found = entries.groupBy(JOB, BATCH).agg(rows.alias("rows")).collect()
        return sorted((r[JOB], r[BATCH], r["rows"]) for r in found if r["rows"] or empty_too)

    def _rows(
        self, spark: SparkSession, table: str, ddl: str, files: Sequence[str], batches: Sequence[tuple[str, int, bool]]
    ) -> DataFrame:
        ddl = f"{ddl}, {FOLDERS[table]} string" if table in FOLDERS else ddl
        ddl = f"{ddl}, {JOB} string, {BATCH} bigint"
        names = spark.createDataFrame([], ddl).columns
        folders = [self._folder(table, job, batch) for job, batch, _ in batches]
        folders = [f for f in folders if _exists(spark, f)]
        parts = [
            spark.read.schema(ddl).option("basePath", base).parquet(*paths).select(*names)
            for base, paths in ((self._compacted(table), files), (f"{self.root}/{table}", folders))
            if paths
        ]
        return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], ddl)

    def unreferenced(self, spark: SparkSession, table: str, keep: int = 1) -> DataFrame:
        """``(file, bytes)`` that none of the last ``keep`` versions needs, nor a reader of new batches.

        Nothing is removed here: when no reader of an older version is left, the store may drop them.
        """
        newest = self.manifest(spark, table)
        if not newest.version:
            return spark.createDataFrame([], "file string, bytes bigint")
        every = spark.read.schema(f"{MANIFEST}, {VERSION} int").parquet(self._manifests(table))
        needed = every.where((F.col(VERSION) > newest.version - keep) & F.col("file").isNotNull()).select("file")
        there = _listed(spark, self._compacted(table))
        if _exists(spark, f"{self.root}/{table}"):
            job, batch = (F.regexp_extract("file", f"/{name}=([^/]+)/", 1) for name in (JOB, BATCH))
            done = every.where((F.col(VERSION) == newest.version) & F.col("file").isNull()).select(JOB, F.col(BATCH).alias("last"))
            batches = _listed(spark, f"{self.root}/{table}").withColumns({JOB: job, "batch": batch.cast("bigint")})
            there = there.unionByName(batches.join(done, JOB).where("batch <= last").select("file", "bytes"))
        return there.join(needed, "file", "left_anti")


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """The data files below a folder and their sizes; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    return [(r["file"], r["bytes"]) for r in _listed(spark, path).collect()]


def _store(spark: SparkSession, path: str):
    """A path and the file system it is in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    place, store = _store(spark, path)
    return store.exists(place)


def _folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a folder column, from the names in one folder."""
    place, store = _store(spark, path)
    names = [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []
    return [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
