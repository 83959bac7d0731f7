"""Tables in parts, published by numbered pointers.

A folder has data, in paths that are written once and never change, and ``versions``: small JSON
files named by number, each of which says of which parts every table consists. The greatest number
is the state of the folder. A version appears by one rename, which fails if its number is taken: a
reader sees all of the old state or all of the new, whatever step a writer stops after, and of two
writers at once the later one is told so and may start again. What a stopped writer leaves belongs
to no version; ``vacuum`` takes it away, with what only old versions need.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import sketches
from ledgerloom.operators.tables import swap_guard, upsert_by_spec, with_keys
from ledgerloom.schemas import TableSpec

#: The column by which a table is cut into parts, in its paths only.
PART = "_part"


class Conflict(RuntimeError):
    """Another writer has published meanwhile."""


@dataclass
class Version:
    """``tables``: the paths of each table's parts, below the folder; ``buckets``: how many a table is cut into by its key."""

    number: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    buckets: dict[str, int] = field(default_factory=dict)


def step(name: str) -> None:
    """Called before each change to a folder; tests stop a writer here."""


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path for it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder; nothing if it isn't there."""
    system, where = file_system(spark, folder)
    return sorted(x.getPath().getName() for x in system.listStatus(where)) if system.exists(where) else []


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename, unless the target is there: then ``Conflict``."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs = jvm.org.apache.hadoop.fs
    here, there = fs.Path(source), fs.Path(target)
    context = fs.FileContext.getFileContext(there.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(here, there, gateway.new_array(fs.Options.Rename, 0))
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            raise Conflict(target) from None
        raise


def latest(spark: SparkSession, folder: str) -> Version:
    """The newest version of a folder; number 0 and no tables before the first."""
    numbers = [int(x) for x in names(spark, f"{folder}/versions") if x.isdigit()]
    return version(spark, folder, max(numbers)) if numbers else Version()


def version(spark: SparkSession, folder: str, number: int) -> Version:
    text = spark.read.text(f"{folder}/versions/{number:010}", wholetext=True).first()[0]
    return Version(**json.loads(text))


def commit(spark: SparkSession, folder: str, new: Version) -> int:
    """Publish a version under its number."""
    system, pointers = file_system(spark, f"{folder}/versions")
    step("make the folder of pointers")
    system.mkdirs(pointers)
    temporary = f"{folder}/versions/.{uuid.uuid4().hex}"
    step("write a pointer")
    out = system.create(file_system(spark, temporary)[1], False)
    out.write(bytearray(json.dumps(vars(new)).encode()))
    out.close()
    step("publish the pointer")
    rename_new(spark, temporary, f"{folder}/versions/{new.number:010}")
    return new.number


def write_parts(df: DataFrame, folder: str, name: str, part: Column | None = None) -> dict[str, str]:
    """Write rows to new paths of a table: part to path. ``part`` tells the part of a row; without it there is one."""
    spark = df.sparkSession
    path = f"data/{name}-{uuid.uuid4().hex}"
    step(f"write {name}")
    if part is None:
        df.write.parquet(f"{folder}/{path}")
        return {"all": path}
    df.withColumn(PART, part).repartition(PART).write.partitionBy(PART).parquet(f"{folder}/{path}")
    return {x.removeprefix(f"{PART}="): f"{path}/{x}" for x in names(spark, f"{folder}/{path}") if x.startswith(PART)}


def publish(frames: dict[str, DataFrame], folder: str) -> int:
    """Put whole new tables in place of those of their names, all at once; the others stay. The version's number.

    A frame may read the tables that it replaces.
    """
    spark = next(iter(frames.values())).sparkSession
    now = latest(spark, folder)
    parts = {name: write_parts(df, folder, name) for name, df in frames.items()}
    kept = {name: n for name, n in now.buckets.items() if name not in parts}
    return commit(spark, folder, Version(now.number + 1, now.tables | parts, kept))


def publish_guarded(df: DataFrame, folder: str, name: str, keys: list[str]) -> int | None:
    """Put a whole new table in place of the one of its name, unless it has fewer rows, none, or fewer distinct keys: then None.

    Each version keeps a sketch of its keys with the table, so the guard reads one row of the old
    state; old rows are read, and keys counted, only where the sketches of both can't tell.
    """
    spark, now, sketch_name = df.sparkSession, latest(df.sparkSession, folder), f"{name}.keys"
    parts = write_parts(df, folder, name)
    new = Version(now.number + 1, {**now.tables, name: parts}, {k: n for k, n in now.buckets.items() if k != name})
    staged = read(spark, folder, name, df.schema, new)
    sketched = write_parts(sketches.sketch(staged, keys), folder, sketch_name)
    new.tables[sketch_name] = sketched
    if staged.isEmpty():
        return None
    if sketch_name in now.tables:
        stored = [read(spark, folder, sketch_name, sketches.SKETCH, at) for at in (now, new)]
        may = sketches.sketched_guard(*stored).first().may_swap
        if may is None:
            may = swap_guard(read(spark, folder, name, df.schema, now), staged, keys).first().may_swap
        if not may:
            return None
    return commit(spark, folder, new)


def read(spark: SparkSession, folder: str, name: str, schema: T.StructType | str, at: Version | None = None, only: list[str] | None = None) -> DataFrame:
    """A table as of a version, the newest if none is given; ``only`` some of its parts. No rows if it isn't there."""
    found = (at or latest(spark, folder)).tables.get(name, {})
    paths = [f"{folder}/{path}" for part, path in sorted(found.items()) if only is None or part in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def bucket(spec: TableSpec, buckets: int) -> Column:
    """The bucket of a row by its key, without regard to case where the key has none."""
    keys = [F.lower(k) if k in spec.nocase else F.col(k) for k in spec.keys]
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merged(batch: DataFrame, folder: str, spec: TableSpec, now: Version, buckets: int) -> tuple[dict[str, str], int]:
    """New parts of a table for those buckets that the keys of ``batch`` fall into, and how many there are in all.

    Only these buckets are read and written. The batch is landed once, as the numbers of its
    buckets, ``buckets`` at most, come to the driver first.
    """
    spark, n = batch.sparkSession, now.buckets.get(spec.name, buckets)
    if spec.name in now.tables and spec.name not in now.buckets:
        raise ValueError(f"{spec.name} wasn't cut into buckets")
    named = batch.select(*((F.col(f.name).try_cast(f.dataType) if f.name in batch.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in spec.schema))
    landed = f"{folder}/data/landed-{uuid.uuid4().hex}"
    step("land the batch")
    with_keys(named, spec.keys).write.parquet(landed)
    rows = spark.read.schema(spec.schema).parquet(landed)
    touched = [str(r[0]) for r in rows.select(bucket(spec, n)).distinct().collect()]
    base = read(spark, folder, spec.name, spec.schema, now, touched)
    parts = write_parts(upsert_by_spec(base, rows, spec), folder, spec.name, bucket(spec, n)) if touched else {}
    step("remove the landed batch")
    file_system(spark, landed)[0].delete(file_system(spark, landed)[1], True)
    return parts, n


def merge(batch: DataFrame, folder: str, spec: TableSpec, buckets: int = 64) -> int:
    """Upsert ``batch`` by key into a table of buckets, of which only those touched are written; the version's number.

    ``buckets`` counts for the first merge. Rows that lack a part of the key go; a batch without rows
    publishes nothing.
    """
    spark = batch.sparkSession
    now = latest(spark, folder)
    parts, n = merged(batch, folder, spec, now, buckets)
    if not parts:
        return now.number
    tables = now.tables | {spec.name: now.tables.get(spec.name, {}) | parts}
    return commit(spark, folder, Version(now.number + 1, tables, now.buckets | {spec.name: n}))


def vacuum(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Remove what none of the newest ``keep`` versions needs: older pointers, their data, and what stopped writers left.

    Not while a writer is at work, whose data isn't published yet. Returns the removed paths.
    """
    numbers = sorted(int(x) for x in names(spark, f"{folder}/versions") if x.isdigit())
    kept = [version(spark, folder, n) for n in numbers[-keep:]]
    used = {path for v in kept for parts in v.tables.values() for path in parts.values()}
    gone = [f"versions/{n:010}" for n in numbers[:-keep]]
    for whole in names(spark, f"{folder}/data"):
        inner = [f"data/{whole}/{x}" for x in names(spark, f"{folder}/data/{whole}") if x.startswith(f"{PART}=")]
        if f"data/{whole}" not in used and not any(x in used for x in inner):
            gone.append(f"data/{whole}")
        elif inner:
            gone += [x for x in inner if x not in used]
    gone += [f"versions/{x}" for x in names(spark, f"{folder}/versions") if re.fullmatch(r"\.[0-9a-f]{32}(\.crc)?", x)]
    for path in gone:
        step(f"remove {path.split('/')[0]}")
        system, where = file_system(spark, f"{folder}/{path}")
        system.delete(where, True)
    return gone
