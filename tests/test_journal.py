"""Swaps of tables that end anywhere: afterwards all tables are old, or all are new."""

import uuid

import pytest

from saleslake.errors import SaleslakeError
from saleslake.plans import gold, silver
from saleslake.sources import ingest, journal, lake
from saleslake.sources.lake import LakeConfig

NAMES = ("a", "b", "c")


class Lost(BaseException):
    """The driver is gone: nothing that handles exceptions runs any more."""


@pytest.fixture
def config(spark):
    return LakeConfig(bronze=f"j_{uuid.uuid4().hex[:8]}")


def stage_all(spark, config, value):
    """Staged tables of one row each."""
    frame = spark.range(value, value + 1)
    return {config.table("bronze", n): lake.stage_table(spark, frame, config, "bronze", n) for n in NAMES}


def contents(spark, config):
    return [
        spark.table(config.table("bronze", n)).first()[0] if lake.table_exists(spark, config.table("bronze", n)) else None
        for n in NAMES
    ]


def tables(spark, config):
    return {t.name for t in spark.catalog.listTables(config.bronze)}


def interrupt(monkeypatch, after, *names, error=Lost):
    """The call number ``after`` (from 0) of the named functions is made, and nothing after it."""
    calls = []
    for name in names:
        owner = journal.Journal if name in ("write", "end") else journal

        def counted(*args, _made=getattr(owner, name)):
            _made(*args)
            calls.append(args)
            if len(calls) == after + 1:
                raise error

        monkeypatch.setattr(owner, name, counted)
    return calls


def restart(monkeypatch, spark, config):
    """A new driver: original functions, and the recovery that begins a run."""
    monkeypatch.undo()
    return lake.recover(spark, config, "bronze")


# The old tables are a and b; c is new: 5 renames, 2 marks, 3 drops.
@pytest.mark.parametrize("after", range(11))
def test_a_driver_lost_after_any_step(spark, config, monkeypatch, after):
    lake.swap(spark, {k: v for k, v in stage_all(spark, config, 1).items() if not k.endswith(".c")})
    lake.drop_tables(spark, lake.leftovers(spark, config, "bronze"))
    new = stage_all(spark, config, 2)
    calls = interrupt(monkeypatch, after, "rename", "write", "drop", "end")
    with pytest.raises(Lost):
        lake.swap(spark, new)
    assert len(calls) == after + 1
    ended = restart(monkeypatch, spark, config)
    assert contents(spark, config) == [2, 2, 2]
    assert tables(spark, config) == set(NAMES)
    assert set(ended.values()) == ({"finished"} if after < 10 else set())
    assert lake.recover(spark, config, "bronze") == {}


@pytest.mark.parametrize("after", range(8))
def test_a_driver_lost_while_recovering(spark, config, monkeypatch, after):
    lake.swap(spark, stage_all(spark, config, 1))
    new = stage_all(spark, config, 2)
    interrupt(monkeypatch, 1, "rename")
    with pytest.raises(Lost):
        lake.swap(spark, new)
    monkeypatch.undo()
    interrupt(monkeypatch, after, "rename", "drop")
    try:
        lake.recover(spark, config, "bronze")
    except Lost:
        pass
    restart(monkeypatch, spark, config)
    assert contents(spark, config) == [2, 2, 2]
    assert tables(spark, config) == set(NAMES)


@pytest.mark.parametrize(("failing", "after"), [*((k, None) for k in range(6)), (5, 0), (5, 2), (5, 4), (4, 1)])
def test_a_failing_rename_brings_the_old_tables_back(spark, config, monkeypatch, failing, after):
    """A rename fails for good; while the tables go back the driver may be lost as well."""
    lake.swap(spark, stage_all(spark, config, 1))
    new = stage_all(spark, config, 2)
    made, calls = journal.rename, []

    def broken(*args):
        calls.append(args)
        if len(calls) == failing + 1:
            raise ValueError("the catalog is away")
        if after is not None and len(calls) == failing + 2 + after:
            raise Lost
        made(*args)

    monkeypatch.setattr(journal, "rename", broken)
    with pytest.raises((ValueError, Lost)):
        lake.swap(spark, new)
    restart(monkeypatch, spark, config)
    assert contents(spark, config) == [1, 1, 1]
    lake.drop_tables(spark, lake.leftovers(spark, config, "bronze"))
    assert tables(spark, config) == set(NAMES)


def test_one_table_that_cannot_go_back_stops_no_other(spark, config, monkeypatch):
    lake.swap(spark, stage_all(spark, config, 1))
    new = stage_all(spark, config, 2)
    made, calls = journal.rename, []

    def broken(_, old, to):
        calls.append((old, to))
        if len(calls) == 6 or (len(calls) > 6 and old.endswith(".a")):
            raise ValueError("the catalog is away")
        made(spark, old, to)

    monkeypatch.setattr(journal, "rename", broken)
    with pytest.raises(ValueError, match="away"):
        lake.swap(spark, new)
    assert contents(spark, config) == [2, 1, 1]
    assert set(restart(monkeypatch, spark, config).values()) == {"undone"}
    assert contents(spark, config) == [1, 1, 1]
    assert tables(spark, config) == set(NAMES)


@pytest.mark.parametrize(("after", "lost"), [(1, "c"), (2, "b")])
def test_a_lost_staged_table_undoes_the_commit(spark, config, monkeypatch, after, lost):
    """Its predecessor may still be in place (c), or aside (b)."""
    lake.swap(spark, stage_all(spark, config, 1))
    new = stage_all(spark, config, 2)
    interrupt(monkeypatch, after, "rename")
    with pytest.raises(Lost):
        lake.swap(spark, new)
    monkeypatch.undo()
    lake.drop_tables(spark, [new[config.table("bronze", lost)]])
    assert set(lake.recover(spark, config, "bronze").values()) == {"undone"}
    assert contents(spark, config) == [1, 1, 1]


def test_a_commit_stays_in_one_schema(spark, config):
    with pytest.raises(SaleslakeError, match="one schema"):
        lake.swap(spark, {"x.a": "x.a1", "y.b": "y.b1"})
    lake.swap(spark, {})
    assert lake.recover(spark, LakeConfig(bronze="nowhere", silver="nor_here", gold="none")) == {}
    assert lake.leftovers(spark, LakeConfig(bronze="nowhere"), "bronze") == []


def test_every_refresh_recovers_first(spark, fixtures, monkeypatch):
    mark = uuid.uuid4().hex[:8]
    config = LakeConfig(f"{fixtures}/gold", bronze=f"b_{mark}", silver=f"s_{mark}", gold=f"g_{mark}")
    builds = [
        (lambda: ingest.ingest_all(spark, config), "bronze", "orders"),
        (lambda: silver.build_silver(spark, config), "silver", "orders"),
        (lambda: gold.build_gold(spark, config), "gold", "sales_by_product"),
    ]
    for build, layer, table in builds:
        build()
        rows = lake.read_table(spark, config, layer, table).count()
        interrupt(monkeypatch, 0, "rename")
        with pytest.raises(Lost):
            build()
        monkeypatch.undo()
        build()
        assert lake.read_table(spark, config, layer, table).count() == rows
        assert lake.leftovers(spark, config, layer) == []
        assert not [t.name for t in spark.catalog.listTables(config.schema_name(layer)) if "__" in t.name]
