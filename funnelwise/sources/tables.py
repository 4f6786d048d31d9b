"""Tables in plain Parquet: a snapshot, and batches of changed rows appended beside it.

A table is a folder with one subfolder `upto=<number>` for each write; the snapshot has number 0, and the row of the
highest number counts. Every write is partitioned by a hash of the key, so that a batch reads the
partitions of its own keys only, and writes the new state of these keys only. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import latest_per_id
from .scratch import delete, shuffles_dropped, subfolders

_NUMBER, _PARTS, _PART = "upto", "key_parts", "key_part"
#: Folder of a table's added columns; readers of the table skip names that start so.
_COLUMNS = "_columns"
#: Rows of a snapshot that a partition holds, where the number of partitions is not given.
PART_ROWS = 1_000_000


def part_of(key: str, parts: int) -> Column:
    """Partition of a key: by its text, so that integers of any width agree."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(parts)).cast("int")


def _write(df: DataFrame, path: str, key: str, parts: int, mode: str) -> None:
    placed = df.withColumns({_PARTS: F.lit(parts), _PART: part_of(key, parts)})
    with shuffles_dropped(df.sparkSession):
        placed.write.partitionBy(_PARTS, _PART).mode(mode).parquet(path)


def write_snapshot(df: DataFrame, path: str, key: str = "id", parts: int | None = None) -> None:
    """Write a table with unique keys in `parts` partitions, each ordered by key so that lookups skip row groups.

    Without `parts` the rows are counted first: a partition holds about PART_ROWS.
    """
    parts = parts or max(1, -(-df.count() // PART_ROWS))
    ordered = df.repartition(parts, part_of(key, parts)).sortWithinPartitions(part_of(key, parts), key)
    _write(ordered, f"{path}/{_NUMBER}=0", key, parts, "error")


def parts_of(spark: SparkSession, path: str) -> int:
    """Number of partitions of a table, from its folders' names."""
    return int(subfolders(spark, f"{path}/{_NUMBER}=0")[0].partition("=")[2])


def _parts(spark: SparkSession, path: str, key: str, schema: T.StructType | None, before: int | None, touched: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of the snapshot, and the newest changed row of each key; with `touched`, of those partitions only."""
    added = [T.StructField(_NUMBER, T.LongType()), T.StructField(_PARTS, T.IntegerType()), T.StructField(_PART, T.IntegerType())]
    reader = spark.read if schema is None else spark.read.schema(T.StructType([*schema.fields, *added]))
    rows = reader.parquet(path)
    if before is not None:
        rows = rows.filter(F.col(_NUMBER) < before)
    if touched is not None:
        rows = rows.join(F.broadcast(touched), _PART, "left_semi")
    plain = [c for c in rows.columns if c not in (_NUMBER, _PARTS, _PART)]
    changed = latest_per_id(rows.filter(F.col(_NUMBER) > 0), key, _NUMBER, [key])
    return rows.filter(F.col(_NUMBER) == 0).select(plain), changed.select(plain)


def read_table(spark: SparkSession, path: str, key: str = "id", schema: T.StructType | None = None, before: int | None = None) -> DataFrame:
    """The current table, or its state before a write. Only the changed keys are joined to the snapshot.

    `schema` names the columns where writes have added some; else one file's columns are taken.
    """
    snapshot, changed = _parts(spark, path, key, schema, before)
    return snapshot.join(changed.select(key), key, "left_anti").select(*changed.columns).unionByName(changed)


def held_rows(source: DataFrame, path: str, key: str = "id", schema: T.StructType | None = None, before: int | None = None) -> DataFrame:
    """Rows that the table holds for the source's keys.

    The partitions of these keys are found first, at most as many numbers as the table has partitions, and are
    broadcast, so that Spark prunes all others at run time.
    """
    spark, keys = source.sparkSession, source.select(key)
    parts = parts_of(spark, path)
    # the comparison is always true; Spark prunes by a side only if it is filtered
    touched = source.select(part_of(key, parts).alias(_PART)).filter(F.col(_PART) >= 0).distinct()
    held = [part.join(keys, key, "left_semi") for part in _parts(spark, path, key, schema, before, touched)]
    return held[0].join(held[1].select(key), key, "left_anti").select(*held[1].columns).unionByName(held[1])


def apply_changes(
    source: DataFrame, path: str, number: int, change: Callable[[DataFrame, DataFrame], DataFrame], key: str = "id", schema: T.StructType | None = None
) -> None:
    """Append change(rows held for the source's keys, source) as write `number`, which must be above the last one.

    A replayed write starts from the state before it and replaces its own files. `source` is read
    several times: pass a table.
    """
    changed = change(held_rows(source, path, key, schema, number), source)
    _write(changed, f"{path}/{_NUMBER}={number}", key, parts_of(source.sparkSession, path), "overwrite")


def table_schema(spark: SparkSession, path: str, declared: T.StructType, before: int | None = None) -> T.StructType:
    """The declared columns and those that writes (before number `before`) have added, in the order of their coming."""
    if not subfolders(spark, f"{path}/{_COLUMNS}"):
        return declared
    added = spark.read.parquet(f"{path}/{_COLUMNS}").orderBy("write", "place").collect()  # one row for each added column
    known, fields = {f.name for f in declared.fields}, list(declared.fields)
    for row in added:
        if row["name"] not in known and (before is None or row["write"] < before):
            known.add(row["name"])
            fields.append(T.StructField(row["name"], T.StructType.fromDDL(f"x {row['type']}")[0].dataType))
    return T.StructType(fields)


def add_columns(spark: SparkSession, path: str, number: int, fields: list[T.StructField]) -> None:
    """Record columns that write `number` adds to a table; rows of older files have NULL there. A replay records them again."""
    rows = [(place, f.name, f.dataType.simpleString()) for place, f in enumerate(fields)]
    table = spark.createDataFrame(rows, "place int, name string, type string")
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/{_COLUMNS}/write={number}")


def fold_changes(spark: SparkSession, path: str, upto: int, key: str = "id", schema: T.StructType | None = None, drop_below: int | None = None) -> None:
    """Gather the changes of all writes before `upto` in the folder of that write, and delete those of writes before `drop_below`.

    `upto` must be the last write, and be final. Rows of keys that it changed itself are there already; those of all other changed
    keys are appended. No state in between reads differently: the newest row of a key is the same in all folders that hold it. A
    repeated fold appends what is not there yet. Folders are deleted later than they are folded, so that readers can finish.
    """
    numbers = [int(f.partition("=")[2]) for f in subfolders(spark, path) if f.startswith(f"{_NUMBER}=")]
    if sum(0 < n <= upto for n in numbers) > 1:
        old = _parts(spark, path, key, schema, upto)[1]
        last = spark.read.parquet(f"{path}/{_NUMBER}={upto}").select(key)
        _write(old.join(last, key, "left_anti"), f"{path}/{_NUMBER}={upto}", key, parts_of(spark, path), "append")
    for n in numbers:
        if 0 < n < (upto if drop_below is None else min(upto, drop_below)):
            delete(spark, f"{path}/{_NUMBER}={n}")


def rewrite_table(spark: SparkSession, path: str, to: str, key: str = "id", schema: T.StructType | None = None, parts: int | None = None) -> None:
    """Fold all changes into a snapshot at a new path, with as many partitions as its rows now need; readers then move there."""
    write_snapshot(read_table(spark, path, key, schema), to, key, parts)
