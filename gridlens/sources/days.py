"""Day directories: open only the days asked for, replace whole days at once.

A table lies below ``<database>/<table>``. Its rows are laid out by day, either
``year=/month=/day=`` (zero-padded when written, either way when read) or
``<date column>=``. Writers put rows into a version folder of their own,
``_days/version=<id>/<day>``, which no reader opens; the database's commit log
``_commits/<number>.json`` says which versions each day of each table consists
of. A commit is a complete file renamed to the next number, never over another
one, so one rename switches any number of days and tables: before it every
reader sees the old days, after it the new ones, and a failure at any step
leaves the old days and the new version folder. Days that no commit names are
read from plain day directories below the table (raw data, older layouts).
Readers test the wanted directories and hand Spark just those, so a daily job
never lists the lake. ``vacuum`` deletes versions that no commit needs.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DayDirs = Callable[[dt.date], list[str]]


def as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def days_between(first_day, last_day) -> list[dt.date]:
    a, b = as_date(first_day), as_date(last_day)
    return [a + dt.timedelta(days=i) for i in range((b - a).days + 1)]


def ymd_dirs(d: dt.date) -> list[str]:
    """Directories a day may have; the first is the one written."""
    months, days = dict.fromkeys((f"{d.month:02d}", str(d.month))), dict.fromkeys((f"{d.day:02d}", str(d.day)))
    return [f"year={d.year}/month={m}/day={x}" for m in months for x in days]


def date_dirs(col: str) -> DayDirs:
    return lambda d: [f"{col}={d.isoformat()}"]


def with_day_parts(df: DataFrame, date_col: str = "reading_date") -> DataFrame:
    """Partition columns ``year, month, day``, the last two zero-padded."""
    d = F.col(date_col)
    return (df.withColumn("year", F.year(d).cast("string"))
              .withColumn("month", F.lpad(F.month(d).cast("string"), 2, "0"))
              .withColumn("day", F.lpad(F.dayofmonth(d).cast("string"), 2, "0")))


class Folders:
    """File system calls for one root, through Hadoop (any scheme)."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self.root, self._path = root.rstrip("/"), self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(self._conf)

    def _at(self, *parts: str):
        return self._path("/".join([self.root, *parts]))

    def exists(self, rel: str) -> bool:
        return bool(self._fs.exists(self._at(rel)))

    def delete(self, rel: str) -> None:
        self._fs.delete(self._at(rel), True)

    def names(self, rel: str) -> list[tuple[str, int]]:
        """Names below a folder with the time of their last change (ms)."""
        if not self.exists(rel):
            return []
        return [(f.getPath().getName(), f.getModificationTime()) for f in self._fs.listStatus(self._at(rel))]

    def matching(self, pattern: str) -> list[str]:
        """Paths that match, relative to the root."""
        found = self._fs.globStatus(self._at(pattern)) or []
        depth = pattern.count("/") + 1
        return ["/".join(f.getPath().toString().split("/")[-depth:]) for f in found]

    def files(self, path: str) -> list[str]:
        """Data files at any depth below a folder (full path)."""
        listing, found = self._fs.listFiles(self._path(path), True), []
        while listing.hasNext():
            at = listing.next().getPath()
            if not at.getName().startswith(("_", ".")):
                found.append(at.toString())
        return found

    def read(self, rel: str) -> str:
        stream = self._fs.open(self._at(rel))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, rel: str, text: str) -> None:
        out = self._fs.create(self._at(rel), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def rename_new(self, src: str, dst: str) -> bool:
        """Rename in one step, never over an existing file: False if there is one."""
        fs = self._jvm.org.apache.hadoop.fs
        none = self._gateway.new_array(fs.Options.Rename, 1)
        none[0] = fs.Options.Rename.NONE
        try:
            fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(self._at(src), self._at(dst), none)
        except Exception as exc:
            if "FileAlreadyExistsException" in str(exc):
                return False
            raise
        return True


#: versions of each day (ISO date) of each table; "" is the plain day directory
Tables = dict[str, dict[str, list[str]]]


class CommitLog:
    """Numbered, write-once commit files of a database folder; the highest
    number counts. Each holds the whole state, a few dozen bytes a day."""

    FOLDER, KEPT = "_commits", 50

    def __init__(self, spark: SparkSession, database: str):
        self.folders = Folders(spark, database)

    def _numbers(self) -> list[int]:
        return sorted(int(n[:10]) for n, _ in self.folders.names(self.FOLDER) if re.fullmatch(r"\d{10}\.json", n))

    def _file(self, number: int) -> str:
        return f"{self.FOLDER}/{number:010d}.json"

    def latest(self) -> tuple[int, Tables]:
        numbers = self._numbers()
        return (numbers[-1], json.loads(self.folders.read(self._file(numbers[-1])))["tables"]) if numbers else (0, {})

    def commit(self, change: Callable[[Tables], None]) -> int:
        """Switch to the latest state with ``change`` applied to it. Another
        writer that takes the number first is not overwritten: the change is
        applied again, to its state."""
        while True:
            number, tables = self.latest()
            change(tables)
            draft = f"{self.FOLDER}/.draft-{uuid.uuid4().hex}"
            self.folders.write_new(draft, json.dumps({"tables": tables}))
            if self._switch(draft, number + 1):
                break
            self.folders.delete(draft)
        for old in self._numbers()[:-self.KEPT]:
            self.folders.delete(self._file(old))
        return number + 1

    def _switch(self, draft: str, number: int) -> bool:
        return self.folders.rename_new(draft, self._file(number))


def _split(root: str) -> tuple[str, str]:
    """Database folder and table name of a table's root."""
    database, _, table = root.rstrip("/").rpartition("/")
    return database, table


def _folders(spark: SparkSession, root: str, days: list[dt.date], dirs: DayDirs,
             versions: dict[str, list[str]]) -> list[tuple[str, list[str]]]:
    """Day directories that exist, below the base path Spark takes their
    directory columns from: plain ones and those of versions."""
    folders = Folders(spark, root)
    plain, versioned = [], []
    for day in days:
        for v in versions.get(day.isoformat(), [""]):
            at = [f"_days/version={v}/{dirs(day)[0]}"] if v else dirs(day)
            (versioned if v else plain).extend(f"{folders.root}/{d}" for d in at if folders.exists(d))
    return [(base, paths) for base, paths in ((folders.root, plain), (f"{folders.root}/_days", versioned)) if paths]


def _scan(spark: SparkSession, root: str, schema: T.StructType, days: list[dt.date], dirs: DayDirs,
          versions: dict[str, list[str]]) -> DataFrame:
    found = [spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)
             for base, paths in _folders(spark, root, days, dirs, versions)]
    if not found:
        return spark.createDataFrame([], schema)
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def day_folders(spark: SparkSession, root: str, first_day, last_day, dirs: DayDirs) -> list[tuple[str, list[str]]]:
    """(base path, day directories) of the days in [first_day, last_day]."""
    database, table = _split(root)
    versions = CommitLog(spark, database).latest()[1].get(table, {})
    return _folders(spark, root, days_between(first_day, last_day), dirs, versions)


def read_days(spark: SparkSession, root: str, schema: T.StructType, first_day, last_day, dirs: DayDirs) -> DataFrame:
    """Rows of the days in [first_day, last_day]; no such day: no rows."""
    database, table = _split(root)
    versions = CommitLog(spark, database).latest()[1].get(table, {})
    return _scan(spark, root, schema, days_between(first_day, last_day), dirs, versions)


def read_table(spark: SparkSession, root: str, schema: T.StructType, dirs: DayDirs) -> DataFrame:
    """Rows of all days of a table."""
    database, table = _split(root)
    versions = CommitLog(spark, database).latest()[1].get(table, {})
    days = {dt.date.fromisoformat(d) for d in versions}
    depth = dirs(dt.date(2000, 1, 1))[0].count("/") + 1
    for found in Folders(spark, root).matching("/".join(["*=*"] * depth)):
        values = [p.split("=", 1)[1] for p in found.split("/")]
        try:
            days.add(dt.date.fromisoformat(values[0]) if depth == 1 else dt.date(*map(int, values)))
        except ValueError:
            continue  # no day (rows without a date)
    return _scan(spark, root, schema, sorted(days), dirs, versions)


class StagedDays:
    """Rows in a version folder of a table, to be published or dropped."""

    def __init__(self, spark: SparkSession, root: str, dirs: DayDirs):
        self.spark, self.dirs, self.folders = spark, dirs, Folders(spark, root)
        self.version = uuid.uuid4().hex
        self.name = f"_days/version={self.version}"

    @property
    def path(self) -> str:
        return f"{self.folders.root}/{self.name}"

    def rows(self, schema: T.StructType, first_day, last_day) -> DataFrame:
        """The staged rows of the days in [first_day, last_day]."""
        days = days_between(first_day, last_day)
        return _scan(self.spark, self.folders.root, schema, days, self.dirs, {d.isoformat(): [self.version] for d in days})

    def publish(self, first_day, last_day) -> None:
        """Replace every day of the range by what was staged for it."""
        publish_together([self], first_day, last_day)

    def drop(self) -> None:
        self.folders.delete(self.name)


def publish_together(staged: list[StagedDays], first_day, last_day, append: bool = False) -> int:
    """Switch the days of the range in all tables (of one database folder) by
    one commit; ``append`` adds the staged rows to the days instead. A day
    without staged rows ends empty, or keeps its rows when appending. If this
    raises, no table has changed and the staged rows are still there: it may
    be called again."""
    databases = {_split(s.folders.root)[0] for s in staged}
    if len(databases) != 1:
        raise ValueError(f"tables of several database folders cannot be switched together: {sorted(databases)}")
    days = days_between(first_day, last_day)
    filled = [(s, [d for d in days if s.folders.exists(f"{s.name}/{s.dirs(d)[0]}")]) for s in staged]

    def change(tables: Tables) -> None:
        for s, with_rows in filled:
            versions = tables.setdefault(_split(s.folders.root)[1], {})
            for d in days:
                new = [s.version] if d in with_rows else []
                versions[d.isoformat()] = versions.get(d.isoformat(), [""]) + new if append else new

    return CommitLog(staged[0].spark, databases.pop()).commit(change)


def vacuum(spark: SparkSession, root: str, older_than_hours: float = 24.0) -> list[str]:
    """Delete version folders of a table that no kept commit names and that
    were written longer ago than any running reader or writer may need; gives
    the versions deleted. Plain day directories are never touched."""
    database, table = _split(root)
    log, folders = CommitLog(spark, database), Folders(spark, root)
    listed = folders.names("_days")  # before the commits: what is switched meanwhile is in them
    now = spark.sparkContext._jvm.System.currentTimeMillis()
    used = {v for n in log._numbers()
            for vs in json.loads(log.folders.read(log._file(n)))["tables"].get(table, {}).values() for v in vs}
    gone = [n[len("version="):] for n, changed in listed
            if n.startswith("version=") and n[len("version="):] not in used and now - changed >= older_than_hours * 3_600_000]
    for v in gone:
        folders.delete(f"_days/version={v}")
    return gone
