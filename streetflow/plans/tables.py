"""Table sinks and maintenance on plain Parquet directories (SNK2-SNK10, SRC16).

Data is never changed in place. Every write goes to folders of its own,
``<root>/<name>[/<col>=<value>]/_v=<version>``, and a small pointer file,
``<root>/_current/<name>``, names the folders that a table consists of: for each
value of its partition column the versions that hold its rows. The pointer moves
last, in one rename. Until then readers see the old table, so a write that fails
or is killed at any point loses nothing, and a replaced range of days changes as
a whole. A pointer may name several tables (``sets``), which then change together.

A partition that was written without rows stays in the pointer without versions,
so a day that has been worked on is told from one that has not (``days``).
Folders that the last commit took out stay for frames that still read them, and
go with the next commit; ``vacuum`` removes what failed writes left. A pointer
has one writer at a time.

All data moves through Spark's writer; the driver only lists, renames and
removes directories through the Hadoop FileSystem API, and holds a table's list
of partitions.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_VERSION = "_v"


@dataclass(frozen=True)
class Entry:
    """What a pointer says of a table. ``parts``: versions by the partition's
    directory value, or under "" without a partition column. ``sources``: what the
    table was derived from, for a job that derives it by parts."""

    schema: str
    by: str | None
    parts: dict[str, list[str]] = field(default_factory=dict)
    sources: dict = field(default_factory=dict)

    def folders(self, name: str) -> list[str]:
        return [f"{name}/{self.by}={p}/{_VERSION}={v}" if self.by else f"{name}/{_VERSION}={v}"
                for p, versions in sorted(self.parts.items()) for v in versions]

    def but(self, parts: dict[str, list[str]], sources: dict | None = None) -> Entry:
        return Entry(self.schema, self.by, parts, self.sources if sources is None else sources)


class TableStore:
    def __init__(self, spark: SparkSession, root: str, schemas: dict | None = None,
                 sets: dict[str, tuple[str, ...]] | None = None):
        """``schemas`` are the tables' declared schemas, ``sets`` the tables that
        share a pointer, by its name."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = dict(schemas or {})
        self._pointer = {t: pointer for pointer, tables in (sets or {}).items() for t in tables}
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # ------------------------------------------------------------ helpers
    def path(self, name: str) -> str:
        """A folder under the root."""
        return f"{self.root}/{name}"

    def _fs(self, path: str):
        p = self._Path(path)
        return p.getFileSystem(self._conf), p

    def _load(self, pointer: str) -> dict:
        """{tables: {name: entry}, retired: [folders]} of a pointer."""
        fs, p = self._fs(f"{self.root}/_current/{pointer}")
        if not fs.exists(p):
            return {"tables": {}, "retired": []}
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def entry(self, name: str) -> Entry | None:
        """The table as its pointer has it."""
        held = self._load(self._pointer.get(name, name))["tables"].get(name)
        return Entry(**held) if held else None

    def _known(self, name: str) -> Entry:
        if (entry := self.entry(name)) is None:
            raise FileNotFoundError(f"no table {name} under {self.root}")
        return entry

    def exists(self, name: str) -> bool:
        """SRC16: a table exists once a version of it was committed."""
        return self.entry(name) is not None

    def create_schema(self) -> None:
        """SNK10: the table root, if absent."""
        fs, p = self._fs(self.root)
        fs.mkdirs(p)

    def read(self, name: str) -> DataFrame:
        """The current table, by its declared schema where there is one."""
        return self.read_entry(name, self._known(name))

    def read_entry(self, name: str, entry: Entry) -> DataFrame:
        """The rows of an entry, committed or not."""
        schema = self.schemas.get(name) or StructType.fromJson(json.loads(entry.schema))
        folders = [self.path(f) for f in entry.folders(name)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        with_version = StructType([*schema.fields, StructField(_VERSION, StringType())])
        return self.spark.read.option("basePath", self.path(name)).schema(with_version).parquet(*folders).drop(_VERSION)

    def partitions(self, name: str, col: str) -> list[str]:
        """Values of a table's partitions that have rows (metadata only)."""
        entry = self.entry(name)
        return sorted(p for p, versions in entry.parts.items() if versions) if entry and entry.by == col else []

    def days(self, name: str) -> DataFrame:
        """(day) of a table partitioned by days: all that were written, those
        without rows too (metadata only)."""
        entry = self.entry(name)
        rows = [(dt.date.fromisoformat(p),) for p in entry.parts] if entry else []
        return self.spark.createDataFrame(rows, "day date")

    # ----------------------------------------------------------- versions
    def write_version(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> Entry:
        """Write ``df`` beside the table; the entry makes it the table once it is
        committed. Partitioned rows are first brought together by partition, and
        AQE splits the large ones, so that not every task writes to every day."""
        version = f"{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        if not partition_by:
            df.write.parquet(f"{self.path(name)}/{_VERSION}={version}")
            return Entry(df.schema.json(), None, {"": [version]})
        (by,) = partition_by
        schema = StructType([f for f in df.schema.fields if f.name != by] + [df.schema[by]])
        rows = df.hint("rebalance", F.col(by)).withColumn(_VERSION, F.lit(version))
        rows.write.partitionBy(by, _VERSION).mode("append").parquet(self.path(name))
        fs, written = self._fs(f"{self.path(name)}/{by}=*/{_VERSION}={version}")
        values = [st.getPath().getParent().getName()[len(by) + 1:] for st in fs.globStatus(written) or []]
        return Entry(schema.json(), by, {v: [version] for v in values})

    def commit(self, entries: dict[str, Entry]) -> None:
        """Make entries the current tables: those of one pointer in one rename.
        Then remove what the commit before this one took out."""
        for pointer in dict.fromkeys(self._pointer.get(n, n) for n in entries):
            now = self._load(pointer)
            new = {n: e for n, e in entries.items() if self._pointer.get(n, n) == pointer}
            old = {n: Entry(**e) for n, e in now["tables"].items() if n in new}
            gone = {f for n, e in old.items() for f in e.folders(n)} - {f for n, e in new.items() for f in e.folders(n)}
            tables = now["tables"] | {n: asdict(e) for n, e in new.items()}
            self._move(pointer, json.dumps({"tables": tables, "retired": sorted(gone)}))
            for folder in set(now["retired"]) - gone:
                self._delete(folder)

    def _move(self, pointer: str, text: str) -> None:
        """Replace a pointer file in one rename."""
        fs, current = self._fs(f"{self.root}/_current/{pointer}")
        _, fresh = self._fs(f"{self.root}/_current/.{pointer}-{uuid.uuid4().hex}")
        stream = fs.create(fresh, True)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        how = gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(current.toUri(), self._conf).rename(fresh, current, how)

    def _delete(self, folder: str) -> None:
        fs, p = self._fs(self.path(folder))
        fs.delete(p, True)
        up = p.getParent()
        if "=" in up.getName() and not fs.listStatus(up):
            fs.delete(up, False)

    def vacuum(self, name: str, older_than: dt.timedelta = dt.timedelta(days=1)) -> None:
        """Remove versions that no pointer names and that are older than any
        write still under way: what failed or killed writes left."""
        held = self._load(self._pointer.get(name, name))
        keep = set(held["retired"]) | {f for n, e in held["tables"].items() for f in Entry(**e).folders(n)}
        limit = time.time_ns() - int(older_than.total_seconds() * 1e9)
        for pattern in (f"{_VERSION}=*", f"*=*/{_VERSION}=*"):
            fs, p = self._fs(f"{self.path(name)}/{pattern}")
            for st in fs.globStatus(p) or []:
                folder = st.getPath()
                up = folder.getParent().getName()
                own = f"{name}/{up}/{folder.getName()}" if "/" in pattern else f"{name}/{folder.getName()}"
                if own not in keep and int(folder.getName()[len(_VERSION) + 1:].split("-")[0]) < limit:
                    self._delete(own)

    # -------------------------------------------------------------- sinks
    def overwrite(self, name: str, df: DataFrame, partition_by: list[str] | None = None,
                  worked_on: list[str] | None = None) -> None:
        """SNK2: replace the whole table and its schema. ``df`` may read the table.
        ``worked_on`` are partitions to be remembered where they get no rows."""
        entry = self.write_version(name, df, partition_by)
        self.commit({name: entry.but(dict.fromkeys(worked_on or [], []) | entry.parts)})

    def appended(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> Entry:
        """The table with the rows of ``df``, written but not committed."""
        new, old = self.write_version(name, df, partition_by), self.entry(name)
        if old is None:
            return new
        return old.but({p: old.parts.get(p, []) + new.parts.get(p, []) for p in old.parts | new.parts})

    def append(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        """SNK1: add rows, all of them or none."""
        self.commit({name: self.appended(name, df, partition_by)})

    def replaced(self, name: str, df: DataFrame, partition_by: list[str]) -> Entry:
        """The table with the partitions of ``df`` replaced, written but not committed."""
        new, old = self.write_version(name, df, partition_by), self.entry(name)
        return new if old is None else old.but(old.parts | new.parts)

    def overwrite_partitions(self, name: str, df: DataFrame, partition_by: list[str]) -> None:
        """SNK5: only the partitions present in ``df`` are replaced."""
        self.commit({name: self.replaced(name, df, partition_by)})

    def replace_range(self, name: str, df: DataFrame, col: str, start: dt.date, end: dt.date) -> None:
        """SNK3: rows of days start..end are replaced in one step; a day in the
        range that receives no rows ends up empty, and is remembered as done. A
        write that fails leaves the days as they were."""
        new = self.write_version(name, df.where(F.col(col).between(F.lit(start), F.lit(end))), [col])
        old = self.entry(name) or new.but({})
        cleared = {day: [] for day in days_of(start, end)}
        self.commit({name: old.but(old.parts | cleared | new.parts)})

    def drop_before(self, name: str, col: str, earliest: dt.date) -> list[str]:
        """SNK6: retention by date; metadata only."""
        entry = self._known(name)
        gone = sorted(p for p in entry.parts if p < earliest.isoformat()) if entry.by == col else []
        if gone:
            self.commit({name: entry.but({p: v for p, v in entry.parts.items() if p not in gone})})
        return gone

    def replace_keys(self, name: str, new_rows: DataFrame, keys: DataFrame, key: str) -> None:
        """SNK4: rows whose ``key`` is among ``keys`` are replaced by ``new_rows``.

        ``keys`` are all keys that were worked on, those without a row in
        ``new_rows`` too, so leftovers of a crashed run go. Where the table holds
        none of them, which is the rule, the new rows are appended."""
        if not self.exists(name):
            self.overwrite(name, new_rows)
            return
        old, keys = self.read(name), keys.select(key).distinct()
        if old.join(keys, key, "left_semi").isEmpty():
            self.append(name, new_rows)
        else:
            self.overwrite(name, old.join(keys, key, "left_anti").unionByName(new_rows))

    def keep_referenced(self, name: str, key: str, referenced: DataFrame) -> None:
        """SNK7/JN16: drop rows whose key no longer appears in ``referenced``
        (a NOT IN over never-NULL keys); nothing is written if there are none."""
        rows, keys = self.read(name), referenced.select(key).distinct()
        if not rows.join(keys, key, "left_anti").isEmpty():
            self.overwrite(name, rows.join(keys, key, "left_semi"))


def days_of(start: dt.date, end: dt.date) -> list[str]:
    """The days start..end as partition values."""
    return [(start + dt.timedelta(days=i)).isoformat() for i in range((end - start).days + 1)]
