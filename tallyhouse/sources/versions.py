"""Tables whose content changes in one step, and whose old content stays readable.

A table is a folder. Each load writes a folder of its own, ``data/load=<id>``, possibly with partition folders below it;
``versions/<number>.json`` lists the folders one version is made of. A load becomes visible when its list is renamed
into place, so a load that fails leaves the last version as it was. Nothing that a version lists is
ever written again: a change takes folders in or leaves folders out. Superseded versions are removed by
:meth:`VersionedTable.expire`, which keeps the latest ones for readers that have begun. One writer at a time.

Rows can be dealt to buckets by the hash of some columns, so that grouping or joining by them needs no shuffle. Spark knows
buckets from its catalog only, so a version that has them is read through an external catalog entry over its folders; the list
of the version, not the entry, says what the table is.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhouse.session import COMPRESSION, brief_shuffles

# What Spark writes for a null partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# One task reads a bucket. Buckets above this size that are as many times larger than their share are too uneven for that.
LARGE_BUCKET, UNEVEN = 256 << 20, 4
# Folders added to a catalog entry at once.
ADDED = 500


@dataclass(frozen=True)
class Buckets:
    """Rows are dealt to ``number`` buckets by the hash of ``columns``."""

    number: int
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    folders: tuple[str, ...]
    buckets: Buckets | None = None


def parts(folder: str) -> dict[str, str]:
    """Partition values of a folder as text; the load is not one of them."""
    return dict(name.split("=", 1) for name in folder.split("/")[1:])


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._files = self._file(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _file(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names) if names else (self.path,)))

    def _list(self, *names: str) -> list[str]:
        folder = self._file(*names)
        if not self._files.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(folder))

    def numbers(self) -> list[int]:
        return [int(name[:-5]) for name in self._list("versions") if name.endswith(".json") and name[0] != "."]

    def version(self, number: int | None = None) -> Version | None:
        """A version by number, by default the last; none before the first commit."""
        known = self.numbers()
        if not known:
            return None
        number = known[-1] if number is None else number
        stream = self._files.open(self._file("versions", f"{number:08d}.json"))
        try:
            told = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        dealt = told.get("buckets")
        buckets = Buckets(dealt["number"], tuple(dealt["columns"])) if dealt else None
        return Version(number, T.StructType.fromJson(told["schema"]), tuple(told["folders"]), buckets)

    def read(
        self, number: int | None = None, where: Callable[[dict[str, str]], bool] | None = None
    ) -> DataFrame:
        """The rows of a version, or of those of its folders whose partition values ``where`` accepts."""
        version = self.version(number)
        if version is None:
            raise FileNotFoundError(f"no version of {self.path}")
        return self.read_folders(version, [f for f in version.folders if where is None or where(parts(f))])

    def read_folders(self, version: Version, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], version.schema)
        if version.buckets:
            return self.spark.table(self._entry(version, folders)).select(*version.schema.names)
        base = f"{self.path}/data"
        reader = self.spark.read.schema(version.schema).option("basePath", base)
        return reader.parquet(*[f"{base}/{f}" for f in folders]).select(*version.schema.names)

    def _entries(self) -> str:
        """What the names of this table's catalog entries begin with."""
        return f"tallyhouse_{hashlib.sha256(self.path.encode()).hexdigest()[:20]}_v"

    def _entry(self, version: Version, folders: Sequence[str]) -> str:
        """Name of the catalog entry over these folders, which tells Spark the buckets; made if there is none."""
        same = hashlib.sha256("\n".join(folders).encode()).hexdigest()[:20]
        name = f"{self._entries()}{version.number}_{same}"
        if self.spark.catalog.tableExists(name):
            return name
        by = [part.split("=", 1)[0] for part in folders[0].split("/")]
        kinds = {f.name: f.dataType.simpleString() for f in version.schema} | {"load": "string"}
        plain = [n for n in version.schema.names if n not in by]
        quoted = lambda names: ", ".join(f"`{n}`" for n in names)
        literal = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
        base = f"{self.path}/data"
        self.spark.sql(
            f"CREATE TABLE {name} ({', '.join(f'`{n}` {kinds[n]}' for n in [*plain, *by])}) USING parquet "
            f"PARTITIONED BY ({quoted(by)}) CLUSTERED BY ({quoted(version.buckets.columns)}) "
            f"INTO {version.buckets.number} BUCKETS LOCATION {literal(base)}"
        )
        added = []
        for folder in folders:
            values = [part.split("=", 1) for part in folder.split("/")]
            spec = ", ".join(f"`{n}` = {'NULL' if v == NO_VALUE else literal(unquote(v))}" for n, v in values)
            added.append(f"PARTITION ({spec}) LOCATION {literal(f'{base}/{folder}')}")
        for start in range(0, len(added), ADDED):
            self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(added[start : start + ADDED])}")
        return name

    def write(
        self, rows: DataFrame, by: Sequence[str] = (), buckets: Buckets | None = None
    ) -> tuple[str, ...]:
        """Write rows that no version lists yet; returns their folders, one per combination of ``by``."""
        load = f"load=v{max(self.numbers(), default=0) + 1:08d}-{uuid.uuid4().hex}"
        path = f"{self.path}/data/{load}"
        with brief_shuffles(self.spark):
            if buckets:
                self._write_buckets(rows, path, by, buckets)
            else:
                rows.write.partitionBy(*by).options(**COMPRESSION).parquet(path)
        return tuple(self._leaves(load, len(by)))

    def _write_buckets(self, rows: DataFrame, path: str, by: Sequence[str], buckets: Buckets) -> None:
        """Buckets meet in one task each, but AQE splits those that are too large; a bucket may have several files."""
        place = F.pmod(F.hash(*buckets.columns), F.lit(buckets.number))
        dealt = rows.withColumn("_bucket", place).hint("rebalance", "_bucket").drop("_bucket")
        writer = dealt.write.partitionBy(*by).options(**COMPRESSION).bucketBy(buckets.number, *buckets.columns)
        name = f"tallyhouse_{uuid.uuid4().hex}"
        try:
            writer.format("parquet").option("path", path).saveAsTable(name)
        finally:
            # Only the entry goes: the files of a table with a path of its own stay.
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _even(self, folders: Sequence[str], buckets: Buckets) -> bool:
        """Whether one task can read each bucket, by the sizes of the files alone."""
        if not folders:
            return False
        base = f"{self.path}/data"
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load([f"{base}/{f}" for f in folders])
        bucket = F.regexp_extract("path", r"_(\d+)\.c\d+[^/]*$", 1)
        sizes = files.groupBy(bucket.alias("bucket")).agg(F.sum("length").alias("bytes"))
        largest, total = sizes.agg(F.max("bytes"), F.sum("bytes")).first()
        return largest <= max(LARGE_BUCKET, UNEVEN * total // buckets.number)

    def _leaves(self, folder: str, depth: int) -> list[str]:
        if not depth:
            return [folder]
        below = [name for name in self._list("data", folder) if "=" in name]
        return [leaf for name in below for leaf in self._leaves(f"{folder}/{name}", depth - 1)]

    def commit(
        self, schema: T.StructType, folders: Sequence[str], buckets: Buckets | None = None
    ) -> Version:
        """Make ``folders``, all dealt to ``buckets`` if any, the table. The rename is the only step that readers can see."""
        version = Version(max(self.numbers(), default=0) + 1, schema, tuple(folders), buckets)
        dealt = {"number": buckets.number, "columns": list(buckets.columns)} if buckets else None
        text = json.dumps({"schema": schema.jsonValue(), "folders": list(folders), "buckets": dealt})
        draft = self._file("versions", f".{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        final = self._file("versions", f"{version.number:08d}.json")
        if self._files.exists(final) or not self._files.rename(draft, final):
            raise RuntimeError(f"another writer committed version {version.number} of {self.path}")
        return version

    def replace(
        self, rows: DataFrame, by: Sequence[str] = (), buckets: Buckets | None = None
    ) -> Version:
        """Replace all rows. Buckets that turn out very uneven are kept as plain files, so that readers shuffle and split."""
        new = self.write(rows, by, buckets)
        return self.commit(rows.schema, new, buckets if buckets and self._even(new, buckets) else None)

    def append(self, rows: DataFrame, by: Sequence[str] = ()) -> Version:
        old = self.version()
        return self.commit(rows.schema, (*(old.folders if old else ()), *self.write(rows, by)))

    def replace_parts(self, rows: DataFrame, by: Sequence[str], on: Sequence[str] | None = None) -> Version:
        """Replace only the partitions, by the columns ``on`` of ``by``, that ``rows`` has rows of.

        The others keep their files.
        """
        old, new = self.version(), self.write(rows, by)
        of = lambda folder: tuple(parts(folder)[name] for name in on or by)
        touched = {of(folder) for folder in new}
        stay = [f for f in (old.folders if old else ()) if of(f) not in touched]
        return self.commit(rows.schema, (*stay, *new))

    def expire(self, keep: int = 2) -> int:
        """Remove all but the last ``keep`` versions and what only they or failed loads hold; returns the folders removed.

        Loads numbered after the last version may be under way and stay.
        """
        numbers = self.numbers()
        held = {f for n in numbers[-keep:] for f in self.version(n).folders}
        removed = 0
        for load in self._list("data"):
            if int(load[len("load=v") :].split("-")[0]) > max(numbers, default=0):
                continue
            written = self._leaves_of(load)
            for folder in [f for f in written if f not in held]:
                removed += bool(self._files.delete(self._file("data", folder), True))
            if not set(written) & held:
                self._files.delete(self._file("data", load), True)
        for n in numbers[:-keep]:
            for entry in self.spark.sql(f"SHOW TABLES LIKE '{self._entries()}{n}_*'").collect():
                self.spark.sql(f"DROP TABLE IF EXISTS {entry.tableName}")
            self._files.delete(self._file("versions", f"{n:08d}.json"), False)
        return removed

    def _leaves_of(self, folder: str) -> list[str]:
        below = [name for name in self._list("data", folder) if "=" in name]
        return [leaf for name in below for leaf in self._leaves_of(f"{folder}/{name}")] if below else [folder]
