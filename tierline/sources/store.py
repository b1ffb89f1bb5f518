"""Parquet tables in a folder: replace, scan, count, and the check that a write is complete.

A table is a folder of versions. A version is written whole, compared with what was sent, row count and content, and
then committed: a file named by the next generation number, which only one writer can create, names the version.
Readers take the version of the highest generation. A write that fails at any point leaves the table as it was, and
writers of the same table don't touch each other's files.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import timedelta
from statistics import median
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class WriteMismatch(ValueError):
    """Stored rows differ from the rows handed to the writer."""


@dataclass(frozen=True)
class Written:
    table: str
    path: str
    rows_in: int
    rows_stored: int


@dataclass(frozen=True)
class Version:
    """A committed version; `about` is what its writer said of it, `bucket_by` and `buckets` how its files are cut."""

    generation: int
    path: str
    rows: int
    about: dict[str, str] = field(default_factory=dict)
    bucket_by: str | None = None
    buckets: int = 0


def content_digest(schema: T.StructType) -> dict[str, str]:
    """Aggregates that are equal for equal multisets of rows, whatever their order, and else differ but by chance.

    Two 64-bit hashes a row are summed up without overflow. The hash passes over NULLs, so each row's NULL places are
    hashed with it.
    """
    names = [f"array_sort(map_entries(`{f.name}`))" if isinstance(f.dataType, T.MapType) else f"`{f.name}`" for f in schema]
    places = "concat(" + ", ".join(f"if(`{f.name}` IS NULL, '1', '0')" for f in schema) + ")"
    return {
        f"digest_{i}": f"coalesce(sum(cast(xxhash64({', '.join([str(i), places, *names])}) AS decimal(20,0))), 0)" for i in (1, 2)
    }


class Store:
    """Tables below `root`, which every executor must be able to reach.

    The last `keep` versions of a table stay, for readers that have begun. What a writer left behind that was ended
    before its commit is removed when it is older than `abandoned`. Commits need a file system that creates or renames a
    file only where there is none: local ones and HDFS do.
    """

    #: Below the root: a folder a table, a file a generation.
    COMMITS = "_commits"

    def __init__(
        self, spark: SparkSession, root: str, keep: int = 2, abandoned: timedelta = timedelta(days=7), verify_content: bool = True
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep, self.abandoned, self.verify_content = keep, abandoned, verify_content

    # ---- files

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def _names(self, path: str) -> list[str]:
        fs, folder = self._fs(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(folder)) if fs.exists(folder) else []

    def _delete(self, path: str) -> None:
        fs, target = self._fs(path)
        fs.delete(target, True)

    def _create(self, path: str, text: str) -> bool:
        """Creates the file with its whole content, unless there is one; says which."""
        draft = f"{path}.{uuid4().hex}.draft"
        fs, hidden = self._fs(draft)
        fs.mkdirs(hidden.getParent())
        out = fs.create(hidden, False)
        out.write(bytearray(text.encode()))
        out.close()
        target = self._fs(path)[1]
        if fs.getScheme() != "file":
            done = fs.rename(hidden, target)  # false where the target exists
        else:  # a local rename would overwrite; a link is made only where there is none
            files, paths = self.spark._jvm.java.nio.file.Files, self.spark._jvm.java.nio.file.Paths
            local = lambda p: paths.get(fs.makeQualified(p).toUri())
            try:
                files.createLink(local(target), local(hidden))
                done = True
            except Exception as refused:
                if "FileAlreadyExists" not in str(refused):
                    raise
                done = False
        fs.delete(hidden, False)
        return done

    # ---- versions

    def committed(self, table: str) -> list[Version]:
        """The committed versions whose files are there, oldest first."""
        folder, found = f"{self.root}/{self.COMMITS}/{table}", []
        for name in self._names(folder):
            if not name.isdigit():
                continue
            fs, file = self._fs(f"{folder}/{name}")
            try:
                stream = fs.open(file)
                said = json.loads(bytes(stream.readAllBytes()).decode())
                stream.close()
            except Exception as gone:  # another writer has just removed the commit
                if "FileNotFound" in str(gone) or "NoSuchFile" in str(gone):
                    continue
                raise
            path = f"{self.root}/{table}/{said['version']}"
            if fs.exists(self._fs(path)[1]):
                found.append(Version(int(name), path, said["rows"], said["about"], said["bucket_by"], said["buckets"]))
        return found

    def versions(self, table: str) -> list[str]:
        """Folders of the committed versions, oldest first."""
        return [v.path for v in self.committed(table)]

    def current(self, table: str) -> Version:
        known = self.committed(table)
        if not known:
            raise FileNotFoundError(f"no complete version of {table} below {self.root}")
        return known[-1]

    def path(self, table: str) -> str:
        """The folder that holds the table's rows now."""
        return self.current(table).path

    def written_by(self, table: str, **about: str) -> Written | None:
        """The table's newest version, if its writer said all this of it."""
        known = self.committed(table)
        if known and about.items() <= known[-1].about.items():
            return Written(table, known[-1].path, known[-1].rows, known[-1].rows)
        return None

    # ---- reading

    def scan(self, table: str, *columns: str) -> DataFrame:
        """The table's rows; by buckets, where it was written so and no bucket is far larger than the others.

        A bucket is read by one task. Where one of them holds a hot key, the files are read as any others, in splits,
        and joins shuffle (and split) them.
        """
        version = self.current(table)
        df = self._by_buckets(version) if version.buckets and not self.skewed(version) else self.spark.read.parquet(version.path)
        return df.select(*columns) if columns else df

    def bucket_sizes(self, version: Version) -> list[int]:
        """Bytes of each bucket, from the names of the files."""
        sizes = [0] * version.buckets
        fs, folder = self._fs(version.path)
        for status in fs.listStatus(folder):
            stem = status.getPath().getName().split(".")[0]
            if stem.startswith("part-") and "_" in stem:
                sizes[int(stem.rpartition("_")[2])] += status.getLen()
        return sizes

    def skewed(self, version: Version, factor: float = 5.0, least: int = 64 << 20) -> bool:
        """Whether the largest bucket is above `least` bytes and `factor` times the median one."""
        sizes = self.bucket_sizes(version)
        return max(sizes) > least and max(sizes) > factor * median(sizes)

    @staticmethod
    def _bucket_table(version: Version) -> str:
        """The name under which the session's catalog knows how the version's files are cut."""
        return "tierline_" + version.path.rpartition("/")[2].replace("-", "_")

    def _by_buckets(self, version: Version) -> DataFrame:
        name = self._bucket_table(version)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(version.path).schema)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{version.bucket_by}`)"
                f" SORTED BY (`{version.bucket_by}`) INTO {version.buckets} BUCKETS LOCATION '{version.path}'"
            )
        return self.spark.table(name)

    def count(self, table: str) -> int:
        """Answered from the Parquet footers."""
        return self.spark.read.parquet(self.path(table)).count()

    # ---- writing

    def replace(
        self,
        table: str,
        df: DataFrame,
        max_files: int | None = None,
        about: Mapping[str, str] | None = None,
        bucket_by: str | None = None,
        buckets: int = 0,
    ) -> Written:
        """Write a new version, compare what was sent with what is stored, and commit it.

        Rows are counted and digested while they are written, so the input is computed once; the digest of the stored
        rows takes one scan of them. File sizes are left to adaptive execution; `max_files` is for small results only,
        it narrows the last stage. With `bucket_by`, rows of equal key lie in one of `buckets` buckets, and tables cut
        alike meet without a shuffle; a hot key's rows are written by several tasks.
        """
        sent, measures = Observation(), {"rows": "count(1)", **(content_digest(df.schema) if self.verify_content else {})}
        counted = df.observe(sent, *[F.expr(f"{sql} AS `{name}`") for name, sql in measures.items()])
        if max_files:
            counted = counted.coalesce(max_files)
        name = f"v{time.time_ns():020d}-{uuid4().hex[:8]}"
        path = f"{self.root}/{table}/{name}"
        try:
            if bucket_by:
                self._write_buckets(counted, path, bucket_by, buckets)
            else:
                counted.write.parquet(path)
            result = Written(table, path, sent.get["rows"], self._stored(path))
            if result.rows_in != result.rows_stored:
                raise WriteMismatch(f"{table}: sent {result.rows_in} rows, stored {result.rows_stored}")
            if self.verify_content:
                stored = self._read_back(path).selectExpr(*[f"{sql} AS `{k}`" for k, sql in content_digest(df.schema).items()]).first()
                if any(stored[k] != sent.get[k] for k in stored.asDict()):
                    raise WriteMismatch(f"{table}: as many rows are stored as were sent, but not the same ones")
        except BaseException:
            self._delete(path)
            raise
        said = {"version": name, "rows": result.rows_stored, "about": dict(about or {}), "bucket_by": bucket_by, "buckets": buckets if bucket_by else 0}
        self._commit(table, json.dumps(said))
        self._expire(table)
        return result

    def _write_buckets(self, df: DataFrame, path: str, key: str, buckets: int) -> None:
        """Through a table of the session's catalog, which is dropped again: the files are all that stays."""
        name = f"tierline_new_{uuid4().hex}"
        dealt = df.hint("rebalance", buckets, F.col(key))
        try:
            dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _stored(self, path: str) -> int:
        return self._read_back(path).count()

    def _read_back(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    def _commit(self, table: str, text: str) -> None:
        folder = f"{self.root}/{self.COMMITS}/{table}"
        while True:
            known = [int(x) for x in self._names(folder) if x.isdigit()]
            if self._create(f"{folder}/{max(known, default=0) + 1:020d}", text):
                return

    def _expire(self, table: str) -> None:
        """Drops committed versions beyond the last ones, and files that were abandoned before their commit."""
        known = self.committed(table)
        for old in known[: -self.keep]:
            self._delete(f"{self.root}/{self.COMMITS}/{table}/{old.generation:020d}")
            if old.buckets:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._bucket_table(old)}")
            self._delete(old.path)
        names = {v.path.rpartition("/")[2] for v in known}
        for name in self._names(f"{self.root}/{table}"):
            begun = name[1:].split("-")[0]
            if name not in names and begun.isdigit() and time.time_ns() - int(begun) > self.abandoned / timedelta(microseconds=1) * 1_000:
                self._delete(f"{self.root}/{table}/{name}")
