"""Attaching the row of a unique-key relation to a big relation, without fan-out and skew-safe.

Two plans, chosen by a checked size:

* the relation has at most ``max_broadcast_rows`` rows (its rows are a few fixed-width columns, so
  this is a proven byte bound): broadcast hash join, the big side is not shuffled;
* otherwise a shuffle join on (key, salt). A key is cut into slices of ``slice_rows`` rows: at most a
  million, at most 1/SLICES of the big side, but never so few that more than HEAVY_KEYS keys could be
  that heavy. So what is broadcast has a fixed bound and is copied at most twice that often, however big
  the data is. NULL keys, which can never match, are spread.

Whether a key is duplicated is asked of every row, and almost none has such a key. Where the duplicated keys
are too many to broadcast, a bitmap of their hashes is not (BITMAP_WORDS rows of two fixed-width columns, whatever
the data): rows whose bit is not set are done without a shuffle, and only the others meet the exact keys in
the shuffle join. For that the rows are read twice, once for each kind.

Whether a key has no parent is asked in the same way where the parents are too many to broadcast and only their existence
counts: the keys without one are found by the aggregate that counts the keys, and rows meet those few instead of all parents.

What has to be known of the keys for several lookups (totals, duplicated and heavy keys) comes from one
aggregate over the key columns, ``key_statistics``, before any join.

Shuffles whose rows are known beforehand get their number of partitions from them (``partitions``): what a task sorts
and groups is then the same at every scale, whatever the session's number of partitions and target sizes are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from saleslake.sources.contracts import ROW_ID
from saleslake.sources.lake import released

MAX_BROADCAST_ROWS = 1_000_000
SLICES = 2_000
HEAVY_KEYS = 100_000
ROWS_PER_TASK = 1_000_000
#: Rows of a partition of a shuffle, and the fewest that are worth a task of their own.
PARTITION_ROWS, LEAST_ROWS = 250_000, 10_000
#: Words of 64 bits of the bitmap of key hashes; with more than BITMAP_KEYS keys too many bits are set to be of use.
BITMAP_WORDS = 1 << 19
BITMAP_KEYS = BITMAP_WORDS * 64 // 2


def partitions(spark: SparkSession, rows: int) -> int:
    """Partitions for a shuffle of so many rows: at most PARTITION_ROWS in each, and work for every core."""
    return max(-(-rows // PARTITION_ROWS), min(spark.sparkContext.defaultParallelism, -(-rows // LEAST_ROWS)), 1)


def join_partitions(spark: SparkSession, rows: int) -> int:
    """``partitions`` for the sides of a join, and no fewer than ``spark.sql.shuffle.partitions``.

    Spark raises smaller numbers to that one, and may shuffle sides that it has already shuffled into fewer once more.
    """
    return max(partitions(spark, rows), int(spark.conf.get("spark.sql.shuffle.partitions")))


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate results: ``spark.checkpoint.dir``, else one in the warehouse."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        inside = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or inside)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> tuple[DataFrame, int]:
    """Reliable checkpoint of a small intermediate result in the shared folder, and its rows."""
    checkpoint_folder(df.sparkSession)
    with released(df.sparkSession):
        kept = df.select("*").checkpoint(eager=True)  # a lazy one is computed twice: by the job that asks first, and to be written
    return kept, kept.count()


def duplicated_keys(df: DataFrame, key: str) -> DataFrame:
    """Non-null keys carried by more than one row, with their number of copies."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


@dataclass(frozen=True)
class KeyStatistics:
    """Rows of a frame and, per key column, the keys on more than one row (``key``, ``copies``).

    Of columns with known parents also the keys without one (``absent``), and how many these are (``orphaned``).
    """

    total: int
    repeated: DataFrame
    columns: tuple[str, ...]
    types: tuple[str, ...]
    known: dict[str, int]
    absent: DataFrame | None = None
    orphaned: Mapping[str, int] = field(default_factory=dict)

    def _of(self, kept: DataFrame, column: str) -> DataFrame:
        k = self.columns.index(column)
        value = F.col("key").cast(self.types[k]).alias(column)
        return kept.where(F.col("kind") == k).select(value, "copies")

    def copies(self, column: str) -> DataFrame:
        """The repeated keys of a column under its own name and type, and their copies."""
        return self._of(self.repeated, column)

    def orphans(self, column: str) -> DataFrame:
        """The non-null keys of a column without a parent, and their copies."""
        return self._of(self.absent, column)


def key_statistics(df: DataFrame, columns: Sequence[str], parents: Mapping[str, DataFrame] | None = None) -> KeyStatistics:
    """One scan of the key columns and one aggregate with map-side combine for all of them.

    Columns of one type are grouped in that type, which takes less memory a key than text; others as text.
    The keys are kept in a reliable checkpoint; of a nearly unique column these are few. ``parents`` may hold frames whose
    first column has all keys that a column may refer to, in the column's type; they are rows of the same aggregate.
    """
    types = tuple(df.schema[c].dataType.simpleString() for c in columns)
    common = types[0] if len(set(types)) == 1 else "string"
    parents = parents or {}
    pairs = [
        F.struct(F.lit(-1).alias("kind"), F.lit(None).cast(common).alias("key")),
        *(
            F.struct(F.lit(k).alias("kind"), F.col(c).cast(common).alias("key"))
            for k, c in enumerate(columns)
        ),
    ]
    seen = df.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*").where("kind = -1 OR key IS NOT NULL")
    if parents:
        seen = seen.withColumn("parent", F.lit(False))
        for column, keys in parents.items():
            one = F.col(keys.columns[0])
            kind = F.lit(columns.index(column)).alias("kind")
            seen = seen.unionAll(keys.where(one.isNotNull()).select(kind, one.cast(common).alias("key"), F.lit(True)))
        kinds = ", ".join(str(columns.index(c)) for c in parents)
        counts = (
            seen.groupBy("kind", "key")
            .agg(F.count_if(~F.col("parent")).alias("copies"), F.max("parent").alias("parent"))
            .selectExpr("kind", "key", "copies", f"kind IN ({kinds}) AND copies > 0 AND NOT parent AS absent")
            .where("kind = -1 OR copies > 1 OR absent")
        )
    else:
        counts = (
            seen.groupBy("kind", "key")
            .agg(F.count(F.lit(1)).alias("copies"))
            .where("kind = -1 OR copies > 1")
            .withColumn("absent", F.lit(False))
        )
    kept, _ = cut_lineage(counts)
    found = kept.groupBy("kind").agg(
        F.count_if(F.col("copies") > 1).alias("keys"), F.count_if("absent").alias("absent"), F.sum("copies").alias("rows")
    )
    rows = {r["kind"]: r for r in found.collect()}
    known = {c: rows[k]["keys"] if k in rows else 0 for k, c in enumerate(columns)}
    return KeyStatistics(
        rows[-1]["rows"] if -1 in rows else 0, kept.where("copies > 1"), tuple(columns), types, known, kept.where("absent"),
        {c: rows[columns.index(c)]["absent"] if columns.index(c) in rows else 0 for c in parents},
    )


def slice_rows(total: int) -> int:
    """Rows of one key that a task may get."""
    return max(total // HEAVY_KEYS, min(total // SLICES, ROWS_PER_TASK), 1)


def heavy_keys(df: DataFrame, key: str, total: int, counts: DataFrame | None = None) -> DataFrame:
    """heavy_key and slices of the keys above ``slice_rows(total)``; at most HEAVY_KEYS rows."""
    if counts is None:
        counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    most = slice_rows(total)
    return counts.where(F.col("copies") > most).select(
        F.col(key).alias("_heavy_key"), F.ceil(F.col("copies") / most).cast("int").alias("_slices")
    )


def lookup(
    df: DataFrame,
    other: DataFrame,
    key: str,
    other_key: str,
    *,
    other_rows: int,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    counts: DataFrame | None = None,
    total: int | None = None,
    row_id: str = ROW_ID,
    sized: bool = False,
) -> DataFrame:
    """Left join ``other`` (unique on ``other_key``) to every row of ``df``.

    ``other_rows`` is a counted upper bound for the rows of ``other``. ``counts`` and ``total`` may hold
    known copies per key (keys left out have one row) and the rows of ``df``, see ``key_statistics``;
    without them both are counted when needed. ``sized`` gives the shuffle its partitions by the rows of ``df``;
    without it Spark has the choice to broadcast an ``other`` that it finds small, and ``df`` stays where it is.
    """
    if other_rows <= max_broadcast_rows:
        return df.join(F.broadcast(other), F.col(key) == F.col(other_key), "left")

    total = df.count() if total is None else total
    heavy = heavy_keys(df, key, total, counts)
    if counts is None:
        heavy, _ = cut_lineage(heavy)
    spread = F.xxhash64(row_id)
    salted = df.join(F.broadcast(heavy), F.col(key) == F.col("_heavy_key"), "left").withColumn(
        "_salt",
        F.when(F.col(key).isNull(), F.pmod(spread, F.lit(HEAVY_KEYS)))
        .when(F.col("_slices").isNull(), F.lit(0))
        .otherwise(F.pmod(spread, F.col("_slices")))
        .cast("int"),
    )
    copied = (
        other.join(F.broadcast(heavy), F.col(other_key) == F.col("_heavy_key"), "left")
        .withColumn(
            "_other_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1))
        )
        .drop("_heavy_key", "_slices")
    )
    if sized and df.schema[key].dataType == other.schema[other_key].dataType:  # else the join casts a key and shuffles by that
        n = join_partitions(df.sparkSession, total)
        salted, copied = salted.repartition(n, key, "_salt"), copied.repartition(n, other_key, "_other_salt")
    match = (F.col(key) == F.col(other_key)) & (F.col("_salt") == F.col("_other_salt"))
    return salted.join(copied, match, "left").drop("_heavy_key", "_slices", "_salt", "_other_salt")


def orphan_counts(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """key, rows of the non-null keys without a parent.

    The big side is reduced to one row per key before the anti join, so a hot key costs nothing.
    """
    counts = (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parents.where(F.col(parent_key).isNotNull()).select(F.col(parent_key).alias("_parent"))
    return counts.join(known.distinct(), F.col(key) == F.col("_parent"), "left_anti")


def _bit(key: str) -> str:
    return f"pmod(xxhash64(`{key}`), {BITMAP_WORDS * 64}L)"


def key_bitmap(keys: DataFrame, key: str) -> DataFrame:
    """_word, _bits: the bits that the hashes of ``keys`` set, at most BITMAP_WORDS rows."""
    bit = _bit(key)
    words = keys.selectExpr(f"CAST({bit} DIV 64 AS int) AS _word", f"shiftleft(1L, CAST({bit} % 64 AS int)) AS _one")
    return words.groupBy("_word").agg(F.bit_or("_one").alias("_bits"))


def split_by_bitmap(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose key may be one of ``keys``, and those whose key is none (or NULL). No row is shuffled."""
    return split_by_bitmaps(df, {key: keys})


def split_by_bitmaps(df: DataFrame, sets: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``split_by_bitmap`` for several columns at once: the rows of which any key may be in its set, and the others."""
    asked, seen = df, F.lit(False)
    for i, (key, keys) in enumerate(sets.items()):
        bit = _bit(key)
        bitmap = key_bitmap(keys, key).toDF(f"_word_{i}", f"_bits_{i}")
        asked = asked.join(F.broadcast(bitmap), F.expr(f"CAST({bit} DIV 64 AS int) = _word_{i}"), "left")
        seen |= F.expr(f"`{key}` IS NOT NULL AND coalesce(shiftright(_bits_{i}, CAST({bit} % 64 AS int)) & 1L, 0L) = 1L")
    return asked.where(seen).select(*df.columns), asked.where(~seen).select(*df.columns)


@dataclass(frozen=True)
class KeySet:
    """Rows are asked whether their non-null ``column`` is one of ``keys`` (the column and ``copies``; ``known``: how many)."""

    column: str
    name: str
    keys: DataFrame
    known: int


def marked(
    df: DataFrame,
    sets: Sequence[KeySet],
    total: int,
    *,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    **options,
) -> DataFrame:
    """Add a boolean per set. ``total``: rows of ``df``.

    The number of keys decides how a set is attached: broadcast, or by the salted join, for the rows that the bitmaps of the
    sets let through or (too many keys for a bitmap) for all.
    """

    def asked(rows: DataFrame, one: KeySet) -> DataFrame:
        found = f"_of_{one.name}"
        met = lookup(
            rows, one.keys.select(F.col(one.column).alias(found)), one.column, found, other_rows=one.known,
            counts=one.keys, total=total, max_broadcast_rows=max_broadcast_rows, sized=True, **options,
        )
        return met.withColumn(one.name, F.col(found).isNotNull()).drop(found)

    by_bitmap = {s.column: s for s in sets if max_broadcast_rows < s.known <= BITMAP_KEYS}
    if by_bitmap:
        candidates, others = split_by_bitmaps(df, {column: s.keys for column, s in by_bitmap.items()})
        for one in by_bitmap.values():
            candidates, others = asked(candidates, one), others.withColumn(one.name, F.lit(False))
        df = candidates.unionByName(others)
    for one in sets:
        if one.column not in by_bitmap:
            df = asked(df, one)
    return df


def is_duplicated(
    df: DataFrame,
    key: str,
    name: str,
    statistics: KeyStatistics | None = None,
    *,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    **options,
) -> DataFrame:
    """Add boolean ``name``: the non-null key occurs on more than one row.

    Counting per key combines map-side, so no task ever holds all copies of a key. The duplicated
    keys are checkpointed once; see ``marked`` for how they are attached.
    """
    statistics = statistics or key_statistics(df, [key])
    repeated = KeySet(key, name, statistics.copies(key), statistics.known[key])
    return marked(df, [repeated], statistics.total, max_broadcast_rows=max_broadcast_rows, **options)
