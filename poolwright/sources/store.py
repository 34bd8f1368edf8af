"""Versioned table output: tables are written beside their old versions and switched to by one commit.

A ``TableStore`` is a folder on storage that all executors see. ``data/`` holds written parts, ``commits/`` one small
JSON file per commit, numbered from 0. The newest commit is the state: for each table its kind and the parts that make it up.
A part is never changed once a commit names it, so a job may write a table that it reads, readers of an
older version keep reading, and a job that dies leaves parts that no commit names and the old state.

A ``Transaction`` belongs to a run id. It reads the state as of the run's start, writes parts under the run id, and
commits all its tables at once. The commit file is put in place by a rename that fails where the number is taken, so
of two writers one fails. A run id that has committed before is not run again: ``run`` returns its version. A rerun of one that
died first writes over what that attempt left.

Kinds of tables:
  * plain: one part, replaced as a whole;
  * keyed: one part per bucket of the keys' hash; ``merge`` rewrites the buckets that hold a key of the source and no others;
  * appended: parts are added, none is read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolwright.operators.tables import upsert

BUCKET = "_bucket"


class CommitConflict(RuntimeError):
    """Another writer committed since this transaction began."""


@dataclass(frozen=True)
class Table:
    """What a commit says of a table: its schema as JSON, its parts, and for a keyed one the keys and number of buckets."""

    schema: str
    parts: tuple[tuple[int | None, str], ...]
    keys: tuple[str, ...] = ()
    buckets: int = 0
    rows: int | None = None

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


@dataclass(frozen=True)
class Version:
    number: int
    run_id: str
    tables: Mapping[str, Table] = field(default_factory=dict)


class _Files:
    """The few file operations that a commit needs, by Hadoop's API, so that any store that Spark reads will do."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        conf = spark._jsc.hadoopConfiguration()
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), conf)
        rename = getattr(self.jvm, "org.apache.hadoop.fs.Options$Rename")
        self.no_overwrite = spark.sparkContext._gateway.new_array(rename, 1)
        self.no_overwrite[0] = rename.NONE

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str, scratch: str) -> bool:
        """Put a whole file in place, or say that the name is taken."""
        stream = self.fs.create(self.path(scratch), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            self.context.rename(self.path(scratch), self.path(name), self.no_overwrite)
        except Exception as exc:
            if "FileAlreadyExistsException" not in str(exc):
                raise
            self.fs.delete(self.path(scratch), False)
            return False
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._files = _Files(spark, self.root)

    # --- reading

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._files.names(f"{self.root}/commits") if n.endswith(".json"))

    def version(self, number: int | None = None) -> Version:
        """The newest version, or one by number; before the first commit, version -1 without tables."""
        if number is None:
            number = max(self._numbers(), default=-1)
        if number < 0:
            return Version(-1, "")
        said = json.loads(self._files.read(f"{self.root}/commits/{number:010d}.json"))
        tables = {n: Table(t["schema"], tuple((b, p) for b, p in t["parts"]), tuple(t["keys"]), t["buckets"], t["rows"]) for n, t in said["tables"].items()}
        return Version(number, said["run_id"], tables)

    def _load(self, table: Table, parts: Iterable[str]) -> DataFrame:
        paths = [f"{self.root}/{p}" for p in parts]
        return self.spark.read.schema(table.struct).parquet(*paths) if paths else self.spark.createDataFrame([], table.struct)

    def read(self, name: str, version: Version | None = None) -> DataFrame:
        table = (version or self.version()).tables[name]
        return self._load(table, (p for _, p in table.parts))

    def versions(self) -> list[Version]:
        return [self.version(n) for n in self._numbers()]

    # --- writing

    def run(self, run_id: str, job: Callable[[Transaction], None]) -> Version:
        """Run ``job`` and commit what it put, once for a run id: one that has committed is not run again."""
        done = next((v for v in reversed(self.versions()) if v.run_id == run_id), None)
        if done is not None:
            return done
        tx = Transaction(self, run_id, self.version())
        job(tx)
        return tx.commit()

    def vacuum(self, keep: int = 1) -> int:
        """Delete the parts that none of the newest ``keep`` versions names, and the older commits; returns how many parts went.

        Not to be run beside a transaction: what one has written isn't named yet.
        """
        numbers = self._numbers()
        named = {p for n in numbers[-keep:] for t in self.version(n).tables.values() for _, p in t.parts}
        gone = 0
        for n in numbers[:-keep]:
            self._files.delete(f"{self.root}/commits/{n:010d}.json")
        for run in self._files.names(f"{self.root}/data"):
            for part in self._files.names(f"{self.root}/data/{run}"):
                for leaf in self._files.names(f"{self.root}/data/{run}/{part}") if part.endswith(".buckets") else [""]:
                    path = f"data/{run}/{part}/{leaf}".rstrip("/")
                    if path not in named:
                        self._files.delete(f"{self.root}/{path}")
                        gone += 1
        return gone


class Transaction:
    """What one run reads and writes; nothing shows until ``commit``."""

    def __init__(self, store: TableStore, run_id: str, base: Version):
        self.store, self.run_id, self.base = store, run_id, base
        self.tables: dict[str, Table] = dict(base.tables)
        self.written: dict[str, int] = {}

    def read(self, name: str) -> DataFrame:
        """The table as of this run: its own writes, else as of its start."""
        table = self.tables[name]
        return self.store._load(table, (p for _, p in table.parts))

    def _write(self, name: str, df: DataFrame, buckets: bool = False) -> tuple[str, int]:
        """Write rows as one part (or a part per bucket) and count them on the way: no second scan."""
        where = f"data/{self.run_id}/{name}-{len(self.written)}{'.buckets' if buckets else ''}"
        seen = Observation()
        out = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        (out.partitionBy(BUCKET) if buckets else out).parquet(f"{self.store.root}/{where}")
        rows = seen.get["rows"]
        self.written[where] = rows
        return where, rows

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Replace a plain table; ``df`` may read it."""
        where, rows = self._write(name, df)
        self.tables[name] = Table(df.schema.json(), ((None, where),), rows=rows)
        return self.read(name)

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows to a table without reading it."""
        old = self.tables.get(name)
        where, rows = self._write(name, df.select(*old.struct.names) if old else df)
        parts, before = (old.parts, old.rows) if old else ((), 0)
        self.tables[name] = Table(old.schema if old else df.schema.json(), (*parts, (None, where)), rows=None if before is None else before + rows)

    def _parts_of(self, where: str) -> dict[int, str]:
        found = self.store._files.names(f"{self.store.root}/{where}")
        return {int(d.split("=")[1]): f"{where}/{d}" for d in found if d.startswith(f"{BUCKET}=")}

    def put_keyed(self, name: str, df: DataFrame, keys: Sequence[str], buckets: int = 64) -> DataFrame:
        """Replace a table by one in buckets of its keys' hash."""
        dealt = df.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(buckets, BUCKET)
        where, rows = self._write(name, dealt, buckets=True)
        self.tables[name] = Table(df.schema.json(), tuple(sorted(self._parts_of(where).items())), tuple(keys), buckets, rows)
        return self.read(name)

    def merge(self, name: str, source: DataFrame, policy: Mapping[str, str], defaults: Mapping[str, Column] | None = None) -> list[int]:
        """S7 on a keyed table: upsert ``source`` (unique on the keys), reading and rewriting only the buckets that hold one of
        its keys. Returns those buckets, of which there are at most as many as the table has."""
        table = self.tables[name]
        at = bucket_of(table.keys, table.buckets)
        touched = sorted(r[0] for r in source.select(at.alias("b")).distinct().collect())
        old = self.store._load(table, (p for b, p in table.parts if b in set(touched)))
        new = upsert(old, source, table.keys, policy, defaults)
        where, _ = self._write(name, new.withColumn(BUCKET, at).repartition(max(1, len(touched)), BUCKET), buckets=True)
        parts = {b: p for b, p in table.parts if b not in set(touched)} | self._parts_of(where)
        self.tables[name] = replace(table, parts=tuple(sorted(parts.items())), rows=None)
        return touched

    def rows(self, name: str) -> int | None:
        """Rows of a table as counted when it was written (None after a merge)."""
        return self.tables[name].rows

    def commit(self) -> Version:
        number = self.base.number + 1
        said = {"run_id": self.run_id, "tables": {n: {"schema": t.schema, "parts": t.parts, "keys": t.keys, "buckets": t.buckets, "rows": t.rows} for n, t in self.tables.items()}}
        root = self.store.root
        if not self.store._files.create(f"{root}/commits/{number:010d}.json", json.dumps(said), f"{root}/commits/{self.run_id}.tmp"):
            raise CommitConflict(f"version {number} of {root} was committed by another run; run {self.run_id} again")
        return Version(number, self.run_id, dict(self.tables))
