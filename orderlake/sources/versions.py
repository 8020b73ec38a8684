"""Tables whose readers see one whole version while the next one is written.

Rows lie in folders that are written once and never changed. A version names the folders that make up the table; it is a
small file that appears whole under the next number, or not at all if another writer was first. A reader resolves the
newest version once and keeps to it. What a failed job wrote is in no version and is removed by ``vacuum``.

A table has named parts (a load, a build, a month). A part says which folders' rows it covers (its own; after a compaction
those it was put together from) and which folders of another table it was made from: so a derived table knows what is new
to it without reading either. With ``bucket_by`` the rows of a part are split by a hash of that column, and a reader that
names buckets opens only theirs.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.sources import files

BUCKETS = 32
_DAY_MS = 24 * 3600 * 1000


class ConcurrentCommit(RuntimeError):
    """Another writer committed first; what was read is no longer current."""


@dataclass(frozen=True)
class Part:
    folder: str
    covers: tuple[str, ...]
    sources: tuple[str, ...] = ()


@dataclass(frozen=True)
class Snapshot:
    """One version: its parts by name, and whatever the writer keeps with it."""

    number: int = 0
    parts: Mapping[str, Part] = field(default_factory=dict)
    notes: Mapping[str, object] = field(default_factory=dict)

    def covered(self, names: Iterable[str] | None = None) -> set[str]:
        return {f for n in (self.parts if names is None else names) for f in self.parts[n].covers}


def bucket_of(column: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


class VersionedTable:
    """``part_column`` names the parts in the rows read; ``schema`` is that of the rows themselves."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        part_column: str,
        bucket_by: str | None = None,
        buckets: int = BUCKETS,
    ) -> None:
        self.spark, self.path, self.schema = spark, path, schema
        self.part_column, self.bucket_by, self.buckets = part_column, bucket_by, buckets

    # --- versions ---------------------------------------------------------

    def _file(self, number: int) -> str:
        return f"{self.path}/versions/{number:010d}.json"

    def _numbers(self) -> list[int]:
        names = (name for name, _ in files.list_names(self.spark, f"{self.path}/versions"))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def version(self, number: int) -> Snapshot:
        kept = json.loads(files.read_text(self.spark, self._file(number)))
        parts = {n: Part(p["folder"], tuple(p["covers"]), tuple(p["sources"])) for n, p in kept["parts"].items()}
        return Snapshot(number, parts, kept["notes"])

    def current(self) -> Snapshot:
        numbers = self._numbers()
        return self.version(numbers[-1]) if numbers else Snapshot()

    def commit(
        self, base: Snapshot, changes: Mapping[str, Part | None], notes: Mapping[str, object] | None = None
    ) -> Snapshot:
        """The version after ``base`` with parts put in, replaced or (None) taken out."""
        parts = {n: p for n, p in {**base.parts, **changes}.items() if p is not None}
        new = Snapshot(base.number + 1, parts, dict(base.notes if notes is None else notes))
        text = json.dumps({"parts": {n: asdict(p) for n, p in parts.items()}, "notes": new.notes})
        if not files.put_new(self.spark, self._file(new.number), text):
            raise ConcurrentCommit(f"{self.path}: version {new.number} was committed by another writer")
        return new

    # --- rows --------------------------------------------------------------

    def read(
        self,
        snapshot: Snapshot | None = None,
        names: Iterable[str] | None = None,
        buckets: Iterable[int] | None = None,
    ) -> DataFrame:
        """Rows of a version (the newest one), of all or some parts and buckets, with the name of their part."""
        snapshot = self.current() if snapshot is None else snapshot
        chosen = snapshot.parts if names is None else names
        return self.read_folders({snapshot.parts[n].folder for n in chosen} - {""}, buckets)

    def read_folders(self, folders: Iterable[str], buckets: Iterable[int] | None = None) -> DataFrame:
        extra = [T.StructField(self.part_column, T.StringType())]
        if self.bucket_by:
            extra.append(T.StructField("bucket", T.IntegerType()))
        full = T.StructType(self.schema.fields + extra)
        paths = sorted(f"{self.path}/data/{f}" for f in folders)
        if not paths:
            return self.spark.createDataFrame([], full)
        rows = self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*paths)
        rows = rows.select(*full.fieldNames())
        return rows if buckets is None else rows.where(F.col("bucket").isin(sorted(buckets)))

    def has_folders(self, folders: Iterable[str]) -> bool:
        return all(files.exists(self.spark, f"{self.path}/data/{f}") for f in folders)

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that rows fall into: at most as many numbers as the table has buckets."""
        return sorted(r.b for r in rows.select(bucket_of(self.bucket_by, self.buckets).alias("b")).distinct().collect())

    def write(self, df: DataFrame, name: str, sources: Iterable[str] = ()) -> Part:
        """Write a part's rows; they are in no version yet."""
        return self.write_parts(df.withColumn(self.part_column, F.lit(name)), [name], {name: tuple(sources)})[name]

    def write_parts(
        self, df: DataFrame, names: Iterable[str], sources: Mapping[str, tuple[str, ...]] | None = None
    ) -> dict[str, Part]:
        """Write rows of several parts in one job; ``df`` has the part column, of ``names`` only."""
        write_id = uuid.uuid4().hex
        columns = [*self.schema.fieldNames(), self.part_column]
        by = [self.part_column]
        rows = df.select(*columns)
        if self.bucket_by:
            rows = rows.withColumn("bucket", bucket_of(self.bucket_by, self.buckets))
            by.append("bucket")
        # Files of one bucket together; adaptive execution splits what is large and joins what is small.
        rows = rows.hint("rebalance", *([self.part_column, "bucket"] if self.bucket_by else [self.part_column]))
        rows.write.partitionBy(*by).parquet(f"{self.path}/data/v={write_id}")
        out = {}
        for name in names:
            folder = f"v={write_id}/{part_folder(self.part_column, name)}"
            made = (sources or {}).get(name, ())
            written = files.exists(self.spark, f"{self.path}/data/{folder}")
            out[name] = Part(folder, (folder,), made) if written else Part("", (), made)  # no rows, no folder
        return out

    # --- upkeep ------------------------------------------------------------

    def compact(self, name: str, names: Iterable[str] | None = None) -> Snapshot:
        """Put parts together into one: the same rows in few files. Derived tables find nothing new."""
        base = self.current()
        merged = sorted(base.parts if names is None else names)
        rows = self.read(base, merged)
        sources = dict.fromkeys(s for n in merged for s in base.parts[n].sources)
        part = self.write(rows, name, sources)
        covers = tuple(sorted(base.covered(merged)))
        return self.commit(base, {**dict.fromkeys(merged), name: Part(part.folder, covers, part.sources)})

    def vacuum(self, versions: int = 2, older_than_ms: int = _DAY_MS) -> list[str]:
        """Remove versions but the newest ones, and folders that none of these names.

        Folders changed of late may belong to a job that has not committed yet; they stay.
        """
        numbers = self._numbers()
        kept = [self.version(n) for n in numbers[-versions:]]
        named = {p.folder for s in kept for p in s.parts.values()}
        for number in numbers[:-versions]:
            files.remove(self.spark, self._file(number))
        before, gone = time.time() * 1000 - older_than_ms, []
        for written, changed in files.list_names(self.spark, f"{self.path}/data"):
            if changed > before:
                continue
            folders = [name for name, _ in files.list_names(self.spark, f"{self.path}/data/{written}")]
            held = [f for f in folders if f"{written}/{f}" in named]
            unnamed = [f"{written}/{f}" for f in folders if f.startswith(f"{self.part_column}=") and f not in held]
            for folder in unnamed if held else [written]:
                files.remove(self.spark, f"{self.path}/data/{folder}")
            gone += unnamed
        return gone


def part_folder(column: str, value: str) -> str:
    """Folder name of a partition value, escaped as Spark writes and reads it."""
    special = set("\"#%'*/:=?\\{[]^") | {chr(i) for i in (*range(1, 32), 127)}
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in special else c for c in value)
