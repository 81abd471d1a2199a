"""Loading a batch and checking a warehouse, as jobs."""

from __future__ import annotations

import re
import shutil
from pathlib import Path

import pytest
from conftest import DAY, SIGNUP
from pyspark.sql import functions as F

import run_readout
from liftline.operators.quality import QualityError, constraint_violations
from liftline.schemas import TABLES
from liftline.functions.bloom import likely_in
from liftline.sources import files, journal, upsert as up
from liftline.sources.spoiled import spoiled_tables
from liftline.sources.testbeds import commerce_tables, product_tables

SF = "/root/testdata/sf0.001"


def write(root, frames, fmt="parquet"):
    for name, df in frames.items():
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[name].schema.fields])
        files.write_table(df, files.table_path(str(root), name, fmt), fmt)


def test_a_batch_is_loaded_as_a_whole_or_not_at_all(spark, table, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    users = table("dim_users", {"user_id": 1}, {"user_id": 2})
    tickets = table("fact_support_tickets", {"ticket_id": 1, "user_id": 1, "created_ts": SIGNUP})
    write(tmp_path / "first", {"dim_users": users, "fact_support_tickets": tickets}, "csv")
    assert run_readout.load(spark, str(tmp_path / "first"), warehouse, "csv") == ["dim_users", "fact_support_tickets"]

    orphan = table("fact_support_tickets", {"ticket_id": 2, "user_id": 9, "created_ts": SIGNUP})
    moved = table("dim_users", {"user_id": 2, "country": "FR"})
    write(tmp_path / "bad", {"dim_users": moved, "fact_support_tickets": orphan})
    with pytest.raises(QualityError, match="fact_support_tickets user_id is not in dim_users: 1"):
        run_readout.load(spark, str(tmp_path / "bad"), warehouse)
    kept = files.read_tables(spark, warehouse, ["dim_users", "fact_support_tickets"])
    assert {r["country"] for r in kept["dim_users"].collect()} == {"US"} and kept["fact_support_tickets"].count() == 1

    write(tmp_path / "good", {"dim_users": table("dim_users", {"user_id": 2, "country": "FR"}, {"user_id": 9}), "fact_support_tickets": orphan})
    run_readout.load(spark, str(tmp_path / "good"), warehouse)
    kept = files.read_tables(spark, warehouse, ["dim_users", "fact_support_tickets"])
    assert {r["user_id"]: r["country"] for r in kept["dim_users"].collect()} == {1: "US", 2: "FR", 9: "US"}
    assert kept["fact_support_tickets"].count() == 2
    with pytest.raises(FileNotFoundError):
        run_readout.load(spark, str(tmp_path / "none"), warehouse)


class Died(BaseException):
    """The driver is gone: no handler of ordinary errors runs."""


def contents(spark, root, names=("dim_users", "fact_matches", "fact_support_tickets")):
    there = [n for n in names if not files.missing_inputs(spark, root, [n])]
    return {n: sorted((r[0], r[1]) for r in files.read_table(spark, root, n).select(TABLES[n].key, F.expr({"dim_users": "country", "fact_matches": "therapist_id", "fact_support_tickets": "category"}[n])).collect()) for n in there}


def test_a_load_that_dies_anywhere_leaves_all_old_or_all_new(spark, table, tmp_path, monkeypatch):
    """A new table, a changed table with new and old folders, and death before each call on the file system, clean-up included."""
    users = table("dim_users", *({"user_id": i} for i in range(1, 9)))
    tickets = table("fact_support_tickets", {"ticket_id": 1, "user_id": 1, "created_ts": SIGNUP})
    first = {"dim_users": users, "fact_support_tickets": tickets}
    batch = {
        "fact_matches": table("fact_matches", {"user_id": 2, "matched_ts": SIGNUP}),
        "dim_users": table("dim_users", {"user_id": 2, "country": "FR"}, {"user_id": 50, "country": "IT"}),
        "fact_support_tickets": table("fact_support_tickets", *({"ticket_id": i, "user_id": 50, "created_ts": SIGNUP} for i in (2, 3))),
    }
    up.upsert_tables(spark, str(tmp_path / "base"), first, parts=4)
    old = contents(spark, str(tmp_path / "base"))
    shutil.copytree(tmp_path / "base", tmp_path / "done")
    up.upsert_tables(spark, str(tmp_path / "done"), batch, constraints=True)
    new = contents(spark, str(tmp_path / "done"))
    assert old != new and "fact_matches" in new and "fact_matches" not in old

    # the same staged folders for every try
    shutil.copytree(tmp_path / "base", tmp_path / "staged")
    root = str(tmp_path / "staged")
    moved: list = []
    with monkeypatch.context() as m, pytest.raises(Died):
        m.setattr(up, "publish", lambda folders, run, paths: moved.append((run, paths)) or (_ for _ in ()).throw(Died()))
        up.upsert_tables(spark, root, batch, constraints=True)
    run, paths = moved[0]

    calls = 0

    def dying(at):
        def wrap(method):
            def call(*args):
                nonlocal calls
                calls += 1
                if calls == at:
                    raise Died
                return method(*args)

            return call

        return wrap

    seen = set()
    for at in range(1, 200):
        root = str(tmp_path / f"try{at}")
        shutil.copytree(tmp_path / "staged", root)
        calls = 0
        with monkeypatch.context() as m:
            for name in ("move", "delete"):
                m.setattr(journal.Folders, name, dying(at)(getattr(journal.Folders, name)))
            try:
                journal.publish(journal.Folders(spark, root), run, paths)
            except Died:
                pass
            ended = calls < at
        if at % 3 == 0 and not ended:  # recovery dies as well
            calls = 0
            with monkeypatch.context() as m:
                for name in ("move", "delete"):
                    m.setattr(journal.Folders, name, dying(at // 3)(getattr(journal.Folders, name)))
                try:
                    up.recover(spark, root)
                except Died:
                    pass
        up.recover(spark, root)
        got = contents(spark, root)
        assert got in (old, new), at
        seen.add(got == new)
        assert not any(x.name.startswith("_") for x in Path(root).iterdir())
        if ended:
            break
    assert ended and seen == {True, False}


def test_a_move_that_fails_takes_the_others_back(spark, table, tmp_path, monkeypatch):
    root = str(tmp_path)
    up.upsert_tables(spark, root, {"dim_users": table("dim_users", {"user_id": 1})}, parts=2)
    old = contents(spark, root)
    move = journal.Folders.move

    def failing(self, source, target):
        if "fact_matches" in target and "_staged" in source:
            raise OSError("no space")
        move(self, source, target)

    batch = {"dim_users": table("dim_users", {"user_id": 1, "country": "FR"}), "fact_matches": table("fact_matches", {"user_id": 1, "matched_ts": SIGNUP})}
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(journal.Folders, "move", failing)
        up.upsert_tables(spark, root, batch)
    assert contents(spark, root) == old and up.recover(spark, root) == []


def test_a_batch_of_one_row_leaves_all_other_files_alone(spark, table, tmp_path):
    root = str(tmp_path)
    users = table("dim_users", *({"user_id": i} for i in range(200)))
    up.upsert_tables(spark, root, {"dim_users": users}, parts=8)
    listed = lambda: {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet") if p.is_file()}
    before = listed()
    assert up.upsert_tables(spark, root, {"dim_users": table("dim_users", {"user_id": 7, "country": "FR"})}, constraints=True).keys() == {"dim_users"}
    after = listed()
    changed = {p.rsplit("/", 1)[0] for p, _ in before.items() ^ after.items()}
    assert len(changed) == 1 and len({p.rsplit("/", 1)[0] for p in before}) == 8
    got = {r["user_id"]: r["country"] for r in files.read_table(spark, root, "dim_users").collect()}
    assert got == {i: "FR" if i == 7 else "US" for i in range(200)}


def test_a_table_in_one_piece_is_dealt_at_its_first_load(spark, table, tmp_path):
    root = str(tmp_path)
    write(tmp_path, {"dim_users": table("dim_users", {"user_id": 1}, {"user_id": 2})})
    assert up.Store(spark, root).parts("dim_users") == 0 and up.Store(spark, root).parts("fact_matches") is None
    up.upsert_tables(spark, root, {"dim_users": table("dim_users", {"user_id": 2, "country": "FR"})}, parts=4)
    assert up.Store(spark, root).parts("dim_users") == 4
    assert contents(spark, root)["dim_users"] == [(1, "US"), (2, "FR")]


def test_batches_get_the_verdict_of_the_full_check(spark, tmp_path):
    tables = dict(product_tables(spark, "/root/testdata/sf0.01").items())
    root = str(tmp_path)
    even = {n: df.where("user_id % 2 = 0") for n, df in tables.items()}
    up.upsert_tables(spark, root, even, constraints=True, parts=4)
    spoiled = {n: df.where("user_id % 2 = 1").dropDuplicates([TABLES[n].key]) for n, df in spoiled_tables(tables).items()}
    seen: dict = {}

    def full(after):
        seen["full"] = {(r["rule"], r["violations"]) for r in constraint_violations(after).collect()}
        raise Died

    with pytest.raises(Died):
        up.upsert_tables(spark, root, spoiled, check=full)
    with pytest.raises(QualityError) as broken:
        up.upsert_tables(spark, root, spoiled, constraints=True)
    assert {tuple(x.rsplit(": ", 1)) for x in str(broken.value).split("; ")} == {(r, str(n)) for r, n in seen["full"]}
    assert len(seen["full"]) > 4


def test_only_keys_of_touched_folders_are_read_for_references(spark, table, tmp_path):
    root = str(tmp_path)
    up.upsert_tables(spark, root, {"dim_users": table("dim_users", *({"user_id": i} for i in range(300)))}, parts=16)
    store = up.Store(spark, root)
    keys = spark.createDataFrame([(5,), (6,), (999,)], "user_id long")
    known = store.known("dim_users", keys, "user_id", {})
    plan = known._jdf.queryExecution().executedPlan().toString()
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert schemas == {"user_id:bigint"} and "PartitionFilters: [part" in plan.replace("isnotnull(part", "part")
    assert len(store.touched("dim_users", keys, "user_id")) <= 3
    assert sorted(r[0] for r in known.collect()) == [5, 6]
    with pytest.raises(ValueError, match="neither stored nor in the batch"):
        store.known("fact_subscriptions", keys, "user_id", {})


def test_a_bloom_filter_loses_no_key(spark):
    keys = spark.range(0, 20_000, 7).withColumnRenamed("id", "k").unionByName(spark.createDataFrame([(None,)], "k long"))
    rows = spark.range(0, 40_000).withColumnRenamed("id", "k")
    left = likely_in(rows, "k", keys)
    assert left.join(keys, "k", "left_semi").count() == 20_000 // 7 + 1
    assert left.count() < 20_000 // 7 + 1 + 400
    assert likely_in(rows, "k", keys.where("false")).count() == 0


def test_qa_of_clean_and_spoiled_warehouses(spark, tmp_path):
    assert constraint_violations(dict(product_tables(spark, SF).items())).count() == 0
    write(tmp_path, spoiled_tables(commerce_tables(spark, SF)))
    with pytest.raises(QualityError, match="dim_users device is missing.*fact_cancellations user_id is not in fact_subscriptions"):
        run_readout.qa(spark, str(tmp_path))


def test_readouts_leave_no_scratch_behind(spark, tmp_path):
    from liftline.session import scratch_folder

    with pytest.raises(KeyError), scratch_folder(spark, "work") as path:
        spark.range(3).write.parquet(f"{path}/x")
        raise KeyError
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{path}/x")
