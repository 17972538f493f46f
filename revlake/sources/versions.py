"""Tables as immutable folders under a commit that is put in place whole (INC-4, SNK-1, STR-1).

A table's root holds ``data``, with a folder for each write, and ``commits``, with a small numbered file for each commit. A commit names the folder of each
part of the table: a day, a bucket, a table of a star. Data are written first; they count only from the moment their commit is there, so a failed or
repeated write changes nothing. Commit n + 1 is refused if it is there already, so of two writers that began on commit n one has to begin again.
Folders that neither of the last two commits names are swept; a reader of the commit before may go on reading.

A commit is renamed into place. On HDFS a rename never replaces a file; on local disks and stores where it could, writers must take turns.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


#: The folder of a write, so that Spark takes its name for a column; ``read`` drops it.
WRITE = "revlake_write"


class StaleCommit(ValueError):
    """Another commit came first."""


@dataclass(frozen=True)
class Commit:
    number: int = 0
    #: Folder under the root, by part.
    parts: dict[str, str] = field(default_factory=dict)
    note: dict[str, str] = field(default_factory=dict)


class Folder:
    """The few operations on files that a commit needs, on whatever file system the path is on."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(name))] if self.fs.exists(self.path(name)) else []

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Whether the file was put in place; False if one was there."""
        draft = f"{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(draft), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        done = not self.fs.exists(self.path(name)) and self.fs.rename(self.path(draft), self.path(name))
        if not done:
            self.delete(draft)
        return done


def numbers(folder: Folder) -> list[int]:
    return sorted(int(x) for x in folder.names("commits") if x.isdigit())


def current(spark: SparkSession, root: str, number: int | None = None) -> Commit:
    """The last commit of a table, or the one asked for; one without parts and number 0 if there is none."""
    folder = Folder(spark, root)
    found = numbers(folder)
    if number is None and not found:
        return Commit()
    return Commit(**json.loads(folder.read(f"commits/{number or found[-1]:012d}")))


def write(df: DataFrame, root: str, part: str | None = None) -> dict[str, str]:
    """Writes rows into a new folder and gives the folder of each part: of each value of the column ``part``, or of the only one, named ''. Nothing is committed.

    Values of ``part`` must be plain: days or numbers."""
    folder, name = Folder(df.sparkSession, root), f"data/{WRITE}={uuid.uuid4().hex}"
    if part is None:
        df.write.parquet(f"{root.rstrip('/')}/{name}")
        return {"": name}
    df.repartition(part).write.partitionBy(part).parquet(f"{root.rstrip('/')}/{name}")
    return {x.partition("=")[2]: f"{name}/{x}" for x in folder.names(name) if "=" in x}


def commit(spark: SparkSession, root: str, parts: dict[str, str], on: Commit, note: dict[str, str] | None = None) -> Commit:
    """Puts a commit behind ``on``; ``StaleCommit`` if that isn't the last one any more."""
    folder, new = Folder(spark, root), Commit(on.number + 1, parts, note or {})
    if numbers(folder)[-1:] not in ([], [on.number]) or not folder.write_new(f"commits/{new.number:012d}", json.dumps(new.__dict__)):
        raise StaleCommit(f"commit {new.number} of {root} is there already")
    return new


def sweep(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Deletes commits but the last ``keep``, and data folders that none of these name. Data of a writer that hasn't committed yet go too, so writers sweep themselves, one at a time."""
    folder = Folder(spark, root)
    found = numbers(folder)
    named = {f for n in found[-keep:] for f in current(spark, root, n).parts.values()}
    for n in found[:-keep]:
        folder.delete(f"commits/{n:012d}")
    for write_name in folder.names("data"):
        if not any(f == f"data/{write_name}" or f.startswith(f"data/{write_name}/") for f in named):
            folder.delete(f"data/{write_name}")
        else:
            for x in folder.names(f"data/{write_name}"):
                if "=" in x and f"data/{write_name}/{x}" not in named:
                    folder.delete(f"data/{write_name}/{x}")


def read(spark: SparkSession, root: str, schema: T.StructType | str, parts: list[str] | None = None, at: Commit | None = None) -> DataFrame:
    """The rows of a commit, the last one unless ``at`` is given, or of some of its parts; empty if there are none. ``schema`` names the part's column last, if parts have one."""
    at, schema = at or current(spark, root), T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    folders = [f for p, f in at.parts.items() if parts is None or p in parts]
    if not folders:
        return spark.createDataFrame([], schema)
    root = root.rstrip("/")
    rows = spark.read.schema(T.StructType([*schema, T.StructField(WRITE, T.StringType())])).option("basePath", f"{root}/data").parquet(*(f"{root}/{f}" for f in sorted(folders)))
    return rows.select(*schema.names)
