"""Keyed upsert: an incoming row replaces the stored row with its key, other keys are kept.

Stored tables are dealt into folders by a hash of their key, ``part=00005of00032``. A batch rewrites only the folders its keys fall in, and
its constraints are checked against the batch and the stored keys it refers to, not against all stored rows. Several tables change together or not at
all (``liftline.sources.journal``).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from liftline.functions.bloom import likely_in
from liftline.operators.quality import require_batch
from liftline.schemas import TABLES
from liftline.sources.files import missing_inputs, read_table, table_path
from liftline.sources.journal import STAGED, Folders, publish, recover as recover_folders

#: Folders of a newly stored table, and the bytes one file of a folder should not much exceed.
PARTS, FILE_BYTES = 32, 256 << 20
PART = "part"


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def fresh_rows(target: DataFrame, incoming: DataFrame, keys: list[str], defaults: dict | None = None) -> DataFrame:
    """The rows an upsert writes, with the target's columns. Columns the incoming rows do not carry keep their stored value, or take
    the entry in ``defaults`` for new keys; rows of keys alone change nothing where the key is stored."""
    if all(c in keys for c in incoming.columns):
        fresh = incoming.join(target.select(*keys), keys, "left_anti")
    else:
        fresh = incoming
    absent = [c for c in target.columns if c not in incoming.columns]
    if absent:
        stored = target.select(*keys, *absent).join(incoming.select(*keys), keys, "left_semi")
        fresh = fresh.join(stored, keys, "left")
        for name, value in (defaults or {}).items():
            if name in absent:
                fresh = fresh.withColumn(name, F.coalesce(F.col(name), value))
    return fresh.select(*target.columns)


def upsert(
    target: DataFrame, incoming: DataFrame, keys: list[str], defaults: dict | None = None
) -> DataFrame:
    """The target after the upsert, with the target's columns.

    Incoming keys must be unique; ``upsert_tables`` checks that. The target meets the incoming rows only in anti and semi
    joins, so a small batch is broadcast by size and the stored table is not shuffled.
    """
    if all(c in keys for c in incoming.columns):
        kept = target
    else:
        kept = target.join(incoming.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh_rows(target, incoming, keys, defaults))


def part_of(key: Column, parts: int) -> Column:
    """The folder a key falls in; its name tells how many there are."""
    return F.format_string(f"%05dof{parts:05d}", F.pmod(F.xxhash64(key), F.lit(parts)))


class Store:
    """The stored tables under one root, as a load sees them."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", parts: int = PARTS):
        self.spark, self.root, self.fmt, self.new_parts = spark, root.rstrip("/"), fmt, parts
        self.folders = Folders(spark, root)

    def parts(self, name: str) -> int | None:
        """How many folders a table is dealt into; 0 for a table in one piece, None for one that is not there."""
        there = self.folders.names(table_path("", name, self.fmt).lstrip("/"))
        found = [re.fullmatch(rf"{PART}=\d+of(\d+)", x) for x in there]
        dealt = [int(m[1]) for m in found if m]
        return dealt[0] if dealt else None if missing_inputs(self.spark, self.root, [name], self.fmt) else 0

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name, self.fmt)

    def read_parts(self, name: str, labels: list[str], columns: list[str] | None = None) -> DataFrame:
        """The rows (or some columns) of some folders of a dealt table; the others are not read."""
        schema = T.StructType([*TABLES[name].schema.fields, T.StructField(PART, T.StringType())])
        stored = self.spark.read.schema(schema).format(self.fmt).load(table_path(self.root, name, self.fmt))
        return stored.where(F.col(PART).isin(labels)).select(*(columns or TABLES[name].schema.fieldNames()))

    def touched(self, name: str, keys: DataFrame, column: str) -> list[str]:
        """The folders of a dealt table that the given keys fall in: at most as many as it has."""
        labels = keys.select(part_of(F.col(column), self.parts(name)).alias(PART)).distinct()
        return sorted(r[PART] for r in labels.collect())

    def known(self, name: str, keys: DataFrame, column: str, fresh: dict[str, DataFrame]) -> DataFrame:
        """(column): which of the given keys ``name`` has, among the fresh rows or stored. Of the stored table only the key column of the
        folders is read that the keys fall in, and a Bloom filter of the keys stands before the join."""
        key = TABLES[name].key
        frames = [fresh[name].select(F.col(key).alias(column))] if name in fresh else []
        parts = self.parts(name)
        if parts is not None:
            stored = self.read_parts(name, self.touched(name, keys, column), [key]) if parts else self.read(name).select(key)
            found = likely_in(stored, key, keys, column).withColumnRenamed(key, column)
            frames.append(found.join(keys, column, "left_semi"))
        if not frames:
            raise ValueError(f"{name} is referred to, but neither stored nor in the batch")
        return reduce(DataFrame.unionByName, frames)


def recover(spark: SparkSession, root: str, fmt: str = "parquet") -> list[str]:
    """Take back a load that never ended: the names of the tables that got their old state back."""
    back = recover_folders(Folders(spark, root))
    return [name for name in TABLES if any(path.split("/")[0] == f"{name}.{fmt}" for path in back)]


def upsert_tables(
    spark: SparkSession, root: str, batch: dict[str, DataFrame], fmt: str = "parquet",
    check: Callable[[dict[str, DataFrame]], None] | None = None, constraints: bool = False, parts: int = PARTS,
) -> dict[str, list[str]]:
    """Upsert several stored tables together; gives the folders replaced, by table.

    What changes is first written beside the stored tables; only when all of it is complete are the folders moved, under a journal.
    With ``constraints`` the rows written must keep all constraints; that costs as much as the batch. ``check`` sees all tables as they would
    be. Both may raise; then nothing changes. A load that died with its driver is taken back first.
    """
    recover(spark, root, fmt)
    for name, incoming in batch.items():
        key = TABLES[name].key
        if not repeated_keys(incoming, [key]).isEmpty():
            raise ValueError(f"incoming rows for {name} repeat values of {key}")
        if not incoming.where(F.col(key).isNull()).isEmpty():
            raise ValueError(f"incoming rows for {name} have no {key}")

    store, run = Store(spark, root, fmt, parts), uuid.uuid4().hex
    staged = f"{store.root}/{STAGED}/{run}"
    try:
        changes = {name: _stage(store, name, incoming, staged) for name, incoming in batch.items()}
        fresh = {name: rows for name, (_, rows) in changes.items()}
        if constraints:
            require_batch(fresh, lambda parent, keys, column: store.known(parent, keys, column, fresh))
        if check:
            check(_as_after(store, changes, staged))
    except Exception:
        store.folders.delete(f"{STAGED}/{run}")
        raise
    paths = {name: paths for name, (paths, _) in changes.items()}
    publish(store.folders, run, [p for each in paths.values() for p in each])
    return paths


def _stage(store: Store, name: str, incoming: DataFrame, staged: str) -> tuple[list[str], DataFrame]:
    """Write what an upsert changes in one table. Gives the folders to put in place and the rows it writes anew."""
    spec, parts = TABLES[name], store.parts(name)
    folder = table_path("", name, store.fmt).lstrip("/")
    defaults = {c: F.localtimestamp() for c in spec.optional}
    labels = None
    if parts is None:
        missing = {c: value for c, value in defaults.items() if c not in incoming.columns}
        merged = fresh = incoming.withColumns(missing) if missing else incoming
    else:
        if parts:
            labels = store.touched(name, incoming, spec.key)
            target = store.read_parts(name, labels)
        else:
            target = store.read(name)
        merged, fresh = upsert(target, incoming, [spec.key], defaults), fresh_rows(target, incoming, [spec.key], defaults)
    declared = [F.col(f.name).cast(f.dataType) for f in spec.schema.fields]
    _write(store, merged.select(*declared), name, parts or store.new_parts, labels, table_path(staged, name, store.fmt))
    return [folder] if labels is None else [f"{folder}/{PART}={x}" for x in labels], fresh.select(*declared)


def _write(store: Store, rows: DataFrame, name: str, parts: int, labels: list[str] | None, path: str) -> None:
    if store.fmt != "parquet":
        rows.write.format(store.fmt).save(path)
        return
    key = F.col(TABLES[name].key)
    folder = table_path("", name, store.fmt).lstrip("/")
    wanted = parts if labels is None else len(labels)
    before = [folder] if labels is None else [f"{folder}/{PART}={x}" for x in labels]
    size = sum(store.folders.size(p) for p in before if store.folders.exists(p))
    files = 1 + size // (max(1, wanted) * FILE_BYTES)  # per folder, so that no task writes much more than one file
    dealt = rows.withColumn(PART, part_of(key, parts))
    if wanted:
        dealt = dealt.repartition(wanted * files, PART, F.pmod(F.xxhash64(key, F.lit(1)), F.lit(files)))
    dealt.write.partitionBy(PART).parquet(path)


def _as_after(store: Store, changes: dict[str, tuple[list[str], DataFrame]], staged: str) -> dict[str, DataFrame]:
    """All tables as they would be: untouched folders as they are, the staged ones in place of the others."""
    out = {}
    for name in TABLES:
        if name not in changes:
            if store.parts(name) is not None:
                out[name] = store.read(name)
            continue
        new = read_table(store.spark, staged, name, store.fmt)
        labels = [p.split(f"{PART}=")[1] for p in changes[name][0] if f"{PART}=" in p]
        if labels:
            schema = T.StructType([*TABLES[name].schema.fields, T.StructField(PART, T.StringType())])
            stored = store.spark.read.schema(schema).format(store.fmt).load(table_path(store.root, name, store.fmt))
            new = stored.where(~F.col(PART).isin(labels)).select(*new.columns).unionByName(new)
        out[name] = new
    return out
