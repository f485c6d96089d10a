"""The attach operators under skew: one key, NULL or a group of copies holding a third of all rows."""

import pytest
from pyspark.sql import Window, functions as F

from saleslake.operators import compare, lookup
from saleslake.operators.canonical import canonical, canonical_by_rank
from saleslake.sources.contracts import ROW_ID

ROWS = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third key 7, a third NULL, a third spread over 1,000 keys."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 1000)
    return spark.range(ROWS).select(key.cast("int").alias("k"), F.col("id").alias(ROW_ID), (F.col("id") % 5).alias("v"))


@pytest.fixture(scope="module")
def parents(spark):
    """Every second key has a parent."""
    return spark.range(500).select((F.col("id") * 2 + 1).cast("int").alias("pk"), F.col("id").alias("name"))


def test_salted_and_broadcast_joins_agree(skewed, parents):
    small = lookup.lookup(skewed, parents, "k", "pk", other_rows=500)
    salted = lookup.lookup(skewed, parents, "k", "pk", other_rows=500, max_broadcast_rows=0)
    assert salted.columns == small.columns
    assert salted.count() == ROWS
    diff = compare.difference_counts(small, salted).first()
    assert (diff["only_left"], diff["only_right"]) == (0, 0)


def test_heavy_keys_are_few_and_cut_by_their_share(skewed):
    heavy = {r["_heavy_key"]: r["_slices"] for r in lookup.heavy_keys(skewed, "k", ROWS).collect()}
    assert len(heavy) < lookup.SLICES
    assert abs(heavy[7] - lookup.SLICES / 3) <= 2
    assert sum(heavy.values()) <= 2 * lookup.SLICES


def test_hot_and_null_keys_are_spread_over_the_join_partitions(spark, skewed, parents):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup.lookup(skewed, parents, "k", "pk", other_rows=500, max_broadcast_rows=0)
        per_part = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(per_part) == 8
    assert max(r["count"] for r in per_part) < 2 * ROWS / 8


@pytest.mark.parametrize("limit", [0, lookup.MAX_BROADCAST_ROWS])
def test_duplicates_with_a_hot_group_of_copies(skewed, limit):
    marked = lookup.is_duplicated(skewed, "k", "dup", max_broadcast_rows=limit)
    copies = F.count(F.lit(1)).over(Window.partitionBy("k"))  # the plain form, for the comparison only
    window = skewed.select("*", (F.col("k").isNotNull() & (copies > 1)).alias("dup"))
    diff = compare.difference_counts(window, marked).first()
    assert (diff["only_left"], diff["only_right"]) == (0, 0)


def test_duplicates_use_no_window_and_no_cross_join(skewed):
    plan = lookup.is_duplicated(skewed, "k", "dup", max_broadcast_rows=0)._jdf.queryExecution().toString()
    assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_orphans(skewed, parents):
    found = {r["k"]: r["rows"] for r in lookup.orphan_counts(skewed, "k", parents, "pk").collect()}
    brute = {}
    for r in skewed.collect():
        if r["k"] is not None and r["k"] % 2 == 0:
            brute[r["k"]] = brute.get(r["k"], 0) + 1
    assert found == brute


def test_canonical_of_a_hot_key_combines_before_the_shuffle(skewed):
    first = canonical(skewed, "k", ["v"])
    rows = {r["k"]: r["v"] for r in first.collect()}
    assert rows[7] == 0 and None not in rows
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min_by") >= 1


def test_inexact_copies_and_overlaps(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (1, "a", None), (2, "a", None), (2, None, "a"), (None, "x", "x"), (None, "y", "y")],
        "k int, a string, b string",
    )
    found = [tuple(r) for r in compare.inexact_copies(df, "k", ["a", "b"]).collect()]
    assert found == [(2, 2, 2)]
    pairs = {
        r["pair"]: r["rows"]
        for r in compare.overlaps(
            df, {"no_key": F.col("k").isNull(), "no_a": F.col("a").isNull(), "no_b": F.col("b").isNull()}
        ).collect()
    }
    assert pairs == {"no_key+no_a": 0, "no_key+no_b": 0, "no_a+no_b": 0}


def test_multiset_difference_counts_copies(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "b"), (3, "c")], "a int, b string")
    right = spark.createDataFrame([(1, None), (2, "b"), (2, "b")], "a int, b string")
    found = {(r["a"], r["b"]): (r["only_left"], r["only_right"]) for r in compare.multiset_difference(left, right).collect()}
    assert found == {(1, None): (1, 0), (2, "b"): (0, 1), (3, "c"): (1, 0)}


def test_cut_lineage_reads_the_reliable_checkpoint(spark):
    kept, rows = lookup.cut_lineage(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    assert rows == 10
    lineage = kept._jdf.queryExecution().toRdd().toDebugString()
    assert "ReliableCheckpointRDD" in lineage and "ShuffledRowRDD" not in lineage
    assert sorted(r["k"] for r in kept.collect()) == list(range(10))


def test_canonical_rows_of_texts_equal_the_ranking_window(spark):
    rows = [(None, "n", 1, 0), (1, None, 5, 3), (1, "later", 6, 9), (2, "b", None, 8), (2, "a", 7, 7), (3, "", 2, 4)]
    rows += [(7, f"copy {k}", k, 100 - k) for k in range(50)]
    df = spark.createDataFrame(rows, f"k int, name string, amount int, {ROW_ID} long")
    for attributes in (["name"], ["name", "amount"], ["amount"], []):
        found = sorted(map(str, canonical(df, "k", attributes).collect()))
        assert found == sorted(map(str, canonical_by_rank(df, "k", attributes).collect()))
    assert canonical(df.limit(0), "k", ["name"]).count() == 0


def test_bitmap_lets_every_duplicated_key_through(spark, monkeypatch):
    monkeypatch.setattr(lookup, "BITMAP_WORDS", 4)  # so few bits that unique keys share them
    df = spark.range(2_000).select(
        F.when(F.col("id") < 40, F.col("id") % 20).when(F.col("id") % 9 > 0, F.col("id")).alias("k"), F.col("id").alias(ROW_ID)
    )
    candidates, others = lookup.split_by_bitmap(df, "k", lookup.duplicated_keys(df, "k"))
    assert 40 < candidates.count() < 400 and candidates.count() + others.count() == 2_000
    assert others.where("k < 20").count() == 0
    marked = lookup.is_duplicated(df, "k", "dup", max_broadcast_rows=0)
    assert marked.columns == [*df.columns, "dup"]
    assert marked.where("dup").count() == 40 and marked.where("NOT dup").count() == 1_960
    assert lookup.is_duplicated(df.limit(0), "k", "dup", max_broadcast_rows=0).count() == 0


def test_partitions_follow_the_rows(spark, monkeypatch):
    """Shuffles of known size: their tasks hold so many rows at most, whatever spark.sql.shuffle.partitions (8) is."""
    assert lookup.partitions(spark, 10 * lookup.PARTITION_ROWS + 1) == 11
    assert lookup.partitions(spark, 0) == 1
    monkeypatch.setattr(lookup, "PARTITION_ROWS", 20)
    rows = spark.range(400).selectExpr("id AS _ingest_row_id", "id % 100 AS k")
    known = spark.range(50).withColumnRenamed("id", "parent")
    joined = lookup.lookup(rows, known, "k", "parent", other_rows=50, max_broadcast_rows=0, sized=True)
    assert joined.rdd.getNumPartitions() == 20
    assert (joined.count(), joined.where("parent IS NULL").count()) == (400, 200)


def test_statistics_group_keys_in_their_own_type(spark):
    rows = spark.sql("SELECT * FROM VALUES (1L, 7L, 'x'), (1L, NULL, 'x'), (2L, 7L, 'y') AS t(a, b, c)")
    same = lookup.key_statistics(rows, ["a", "b"])
    assert dict(same.repeated.dtypes)["key"] == "bigint"
    mixed = lookup.key_statistics(rows, ["a", "c"])
    assert dict(mixed.repeated.dtypes)["key"] == "string"
    for found, column, key in ((same, "a", 1), (same, "b", 7), (mixed, "a", 1), (mixed, "c", "x")):
        assert [tuple(r) for r in found.copies(column).collect()] == [(key, 2)]
        assert (found.total, found.known[column]) == (3, 1)


def test_a_kept_result_is_computed_once(spark):
    """The job that writes the checkpoint is the only one that computes the rows."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def noted(k):
        seen.add(1)
        return k

    kept, rows = lookup.cut_lineage(spark.range(10).select(noted("id").alias("k")))
    assert rows == 10 and seen.value == 10
    assert sorted(r["k"] for r in kept.collect()) == list(range(10)) and seen.value == 10
