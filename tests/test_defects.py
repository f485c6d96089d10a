import hashlib
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from saleslake.errors import QualityError
from saleslake.operators import defects

N = 5_000


@pytest.fixture(scope="module")
def clean(spark):
    return spark.range(N).select(
        F.col("id"), (F.col("id") % 50).cast("int").alias("parent"), F.lit(date(2024, 1, 1)).alias("day")
    )


def brute_ranks(seed):
    order = sorted(range(N), key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())
    return {row: rank for rank, row in enumerate(order, 1)}


def test_ranks_equal_a_full_sort(clean):
    expected = brute_ranks(7)
    found = {r["id"]: r["rank"] for r in defects.ranked(clean, "id", 7, 101, 400).collect()}
    assert found == {i: r for i, r in expected.items() if 101 <= r <= 400}


def test_too_many_ranks_are_refused(clean):
    with pytest.raises(QualityError):
        defects.ranked(clean, "id", 7, 1, N + 1)


def test_exactly_k_nulls(clean):
    found = defects.null_out(clean, "parent", 123, id_column="id", seed=7)
    assert found.columns == clean.columns and found.count() == N
    assert found.where("parent IS NULL").count() == 123


def test_orphans_come_from_their_own_namespace(clean):
    found = defects.orphan_out(clean, "parent", 40, 90_001, id_column="id", seed=7)
    planted = sorted(r["parent"] for r in found.where("parent >= 90001").collect())
    assert planted == list(range(90_001, 90_041))


def test_future_days_count_up(clean):
    as_of = date(2026, 8, 31)
    found = defects.future_out(clean, "day", 30, as_of, id_column="id", seed=7)
    planted = sorted(r["day"] for r in found.where(F.col("day") > F.lit(as_of)).collect())
    assert planted == [as_of + timedelta(days=i) for i in range(1, 31)]


def test_copies_are_exact(clean):
    found = defects.copy_rows(clean, 20, id_column="id", seed=7)
    assert found.count() == N + 20
    twice = found.groupBy(*clean.columns).count().where("count = 2")
    assert twice.count() == 20


def test_rank_ranges_do_not_overlap(clean):
    a, b, c = defects.disjoint_ranges(10, 20, 30)
    assert (a, b, c) == (1, 11, 31)
    ids = [
        {r["id"] for r in defects.ranked(clean, "id", 7, first, first + n - 1).collect()}
        for first, n in ((a, 10), (b, 20), (c, 30))
    ]
    assert sum(map(len, ids)) == len(set.union(*ids)) == 60
