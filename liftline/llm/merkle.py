"""A Merkle manifest of a table as a persistent tree: versions of a tampered table copy paths and share the rest.

Every row is a leaf. Per group (source) the leaves, in order, are hashed in runs of ``FAN`` until one node is left, the
subroot; the subroots, in order of their groups, are hashed likewise to the root. The tree is kept as tables, one per ``LEVELS`` levels: a table's
nodes fall into aligned blocks of ``FAN ** LEVELS`` neighbours, a block is one task's work and its top is a node of the next table.

On the way down a block gets the path of its top, the runs on the way to the root, and hands each of its nodes the path through the block.
A tampered leaf makes a version of its own: the nodes on its path are copied with the new digest in place of the old, first within the aligned block,
then along the path given from above, and all untouched nodes are shared. So versions need no shuffle, are as distributed as the blocks, and
a version costs one hash per level. Rows are numbered by a range sort and counts per partition: no group is ever in one task, however many rows it has.

Defined results: a NULL field counts as ``-``, an empty one as no bytes; leaves of a group ascend by id (NULL first), equal ids
by their digests; the NULL group comes first, others in the order of their UTF-8 bytes; repeated rows are leaves of their own; a
row that cannot be tampered with (not chosen, or a NULL text) has no version and folds to the root from its own leaf; a group of one row
is its own subroot; other columns are ignored; no rows give no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from liftline.llm.common import col, ship_package, written

FAN, LEVELS = 16, 3
#: Rows per task when leaves are put in order.
ROWS_PER_TASK = 2_000_000
#: The runs on the way from a node to the root: its place in each, and their digests.
PATH = "array<struct<at:int,run:array<string>>>"


def digest_of(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field_text(value: Column) -> Column:
    """``-`` for NULL, else how many UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]), 256)


def levels(n: int) -> int:
    """How often ``n`` nodes are hashed in runs until one is left."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


def block_runs(digests: list[str], height: int) -> list[list[str]]:
    """The nodes of each level of a block, from its own up to ``height`` levels above."""
    out = [digests]
    for _ in range(height):
        below = out[-1]
        out.append([digest_of(below[k : k + FAN]) for k in range(0, len(below), FAN)])
    return out


def path_in(nodes: list[list[str]], place: int) -> list[dict]:
    """The runs that a node of the lowest level passes on its way up a block."""
    out = []
    for level in nodes[:-1]:
        first = place - place % FAN
        out.append({"at": place % FAN, "run": level[first : first + FAN]})
        place //= FAN
    return out


def copied_path(digest: str, path: list[dict]) -> list[str]:
    """The copies a version makes of the nodes on a path: each run with one digest replaced."""
    out = []
    for step in path:
        run = list(step["run"])
        run[step["at"]] = digest
        digest = digest_of(run)
        out.append(digest)
    return out


def proof_of(path: list[dict]) -> str:
    """One digest of the siblings on a path, from the leaf up, left to right."""
    hashed = hashlib.sha256()
    for step in path:
        for i, x in enumerate(step["run"]):
            if i != step["at"]:
                hashed.update(x.encode())
    return hashed.hexdigest()


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Stored rows with ``key`` and ``order`` columns, and with ``pos``, their number in the order of their key, and ``n``, how many the key has."""
    spark = nodes.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-nodes.count() // ROWS_PER_TASK))
    local = F.monotonically_increasing_id()  # the partition above 33 bits, the row below
    placed = nodes.repartitionByRange(parts, "key", *order).sortWithinPartitions("key", *order).withColumn("local", local)
    placed = written(placed.withColumn("part", F.shiftright("local", 33)), "ordered")
    counts = placed.groupBy("key", "part").agg(F.min("local").alias("first"), F.count(F.lit(1)).alias("k"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition of a key
    counts = counts.withColumns({
        "before": F.coalesce(F.sum("k").over(earlier), F.lit(0)), "n": F.sum("k").over(Window.partitionBy("key")),
    })
    both = placed.join(counts.select("key", "part", "first", "before", "n"), ["key", "part"])
    return both.withColumn("pos", F.col("local") - F.col("first") + F.col("before")).drop("local", "part", "first", "before")


@dataclass
class Forest:
    """One tree per key. ``tables``: the leaves (key, pos, n, digest, ...), then the nodes of every ``LEVELS`` levels above; the last holds
    one node per key."""

    tables: list[DataFrame]

    @property
    def tops(self) -> DataFrame:
        return self.tables[-1].select("key", "digest")


def _in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / FAN**LEVELS))


def grown(leaves: DataFrame) -> Forest:
    """The trees over stored leaves (key, pos, n, digest). A loop over tables: three of them hold 68 billion leaves a key."""
    ship_package(leaves.sparkSession)

    def top(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("pos")
        n = int(frame["n"].iloc[0])
        height = min(LEVELS, levels(n))
        above = -(-n // FAN**height)
        root = block_runs(frame["digest"].tolist(), height)[-1][0]
        return pd.DataFrame({"key": frame["key"].iloc[:1], "pos": frame["block"].iloc[:1], "n": [above], "digest": [root]})

    tables = [leaves]
    while not tables[-1].where("n > 1").isEmpty():
        each = _in_blocks(tables[-1].select("key", "pos", "n", "digest"))
        tables.append(written(each.groupBy("key", "block").applyInPandas(top, "key string, pos long, n long, digest string"), "nodes"))
    return Forest(tables)


def _with_paths(nodes: DataFrame, at: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``function`` of each block: its rows in order, its nodes by level, the path above it and the tag of its tree. The path meets the
    block once, not once a row."""

    def each(frame: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame(columns=names)
        frame = frame.sort_values("pos")
        runs = block_runs(frame["digest"].tolist(), min(LEVELS, levels(int(frame["n"].iloc[0]))))
        return function(frame, runs, list(above["path"].iloc[0]), above["tag"].iloc[0])

    names = [f.split(" ")[0] for f in schema.split(", ")]
    return _in_blocks(nodes).groupBy("key", "block").cogroup(at.groupBy("key", "block")).applyInPandas(each, schema)


PATHS = f"key string, block long, path {PATH}, tag string"


def paths(forest: Forest, above: DataFrame) -> DataFrame:
    """(key, block, path, tag) of the blocks of leaves: ``above`` has the path of each tree's top and a tag (key, path, tag)."""

    def down(frame: pd.DataFrame, runs: list, path: list, tag: str) -> pd.DataFrame:
        found = [path_in(runs, i) + path for i in range(len(frame))]
        return pd.DataFrame({"key": frame["key"], "block": frame["pos"], "path": found, "tag": tag})

    at = above.select("key", F.lit(0).cast("long").alias("block"), "path", "tag")
    for nodes in reversed(forest.tables[1:-1]):
        at = written(_with_paths(nodes, at, down, PATHS), "paths")
    return at


@dataclass
class Manifest:
    """``sources``: the trees of all groups; ``top``: the tree over their subroots; ``root``: NULL without rows."""

    sources: Forest
    top: Forest
    root: str | None
    id_type: str

    def above(self) -> DataFrame:
        """(key, path, tag) of every group: the path of its subroot, and the subroot."""
        start = self.top.tables[0].sparkSession.createDataFrame([("", [], "")], f"key string, path {PATH}, tag string")

        def found(frame: pd.DataFrame, runs: list, path: list, tag: str) -> pd.DataFrame:
            each = [path_in(runs, i) + path for i in range(len(frame))]
            return pd.DataFrame({"key": frame["name"], "path": each, "tag": frame["digest"]})

        return written(_with_paths(self.top.tables[0], paths(self.top, start), found, f"key string, path {PATH}, tag string"), "subroot-paths")


def manifest(rows: DataFrame, id_type: str) -> Manifest:
    """The tree over rows (key, id, digest, changed): ``changed`` is the digest of the tampered row, NULL where there is none."""
    # equal rows are told apart by a number, so that they too can lie in several ranges
    stored = written(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
    sources = grown(written(numbered(stored, ["id", "digest", "row"]).drop("row"), "leaves"))
    subroots = written(sources.tops.select(F.lit("").alias("key"), F.col("key").alias("name"), "digest"), "subroots")
    top = grown(written(numbered(subroots, ["name"]), "top"))
    root = top.tops.first()
    return Manifest(sources, top, root["digest"] if root else None, id_type)


def verified(tree: Manifest) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified, copies) of each row; ``copies`` are the nodes its version
    does not share, from the leaf's parent to the version's root, NULL where there is no version."""
    root = tree.root

    def proofs(frame: pd.DataFrame, runs: list, above: list, subroot: str) -> pd.DataFrame:
        out = []
        for i, (row_id, leaf, changed) in enumerate(zip(frame["id"], frame["digest"], frame["changed"])):
            path = path_in(runs, i) + above
            copies = copied_path(changed or leaf, path)
            folded = copies[-1] if copies else changed or leaf
            out.append((row_id, leaf, subroot, root, proof_of(path), folded, folded == root, copies if changed else None))
        return pd.DataFrame(out, columns=names, dtype=object)

    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "copies"]
    schema = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, copies array<string>"
    # ids pass as text: a NULL would turn a block of long ids into doubles
    leaves = tree.sources.tables[0].withColumn("id", F.col("id").cast("string"))
    found = _with_paths(leaves, paths(tree.sources, tree.above()), proofs, schema)
    return found.withColumn("id", F.col("id").cast(tree.id_type))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def documents_manifest(docs: DataFrame, tampered: Column, fields: tuple = FIELDS, group: str = "source", id_col: str = "doc_id", text_col: str = "text") -> Manifest:
    """The manifest of documents; where ``tampered`` holds, the letters A to Z of the text are lower-cased in a version."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    changed = [F.translate(col(f), upper, lower) if f == text_col else col(f) for f in fields]
    chosen = F.coalesce(tampered, F.lit(False)) & col(text_col).isNotNull()
    rows = docs.select(
        # groups in order: NULL first, then by their bytes
        F.coalesce(F.concat(F.lit("+"), col(group).cast("string")), F.lit("")).alias("key"), col(id_col).alias("id"),
        row_digest([col(f) for f in fields]).alias("digest"), F.when(chosen, row_digest(changed)).alias("changed"),
    )
    return manifest(rows, docs.schema[id_col].dataType.simpleString())
