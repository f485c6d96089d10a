"""Byte-exact fingerprints of files of any size, from a split scan.

A file is the sequence of its byte strings between line feeds (carriage returns belong to them), and its
size, which tells whether it ends in a line feed. The fingerprint of a range is (hash, length): the polynomial
``h[0] + h[1] B + h[2] B^2 + ...`` over the hashes of its lines modulo a prime, and their number. Two ranges that
follow each other merge to ``(hash1 + B^length1 hash2, length1 + length2)``, so ranges are scanned in any
cut and any order, and their fingerprints are merged in the order of their offsets in a tree: ranges of
SPAN bytes first, then the spans of a file. Equal bytes agree whatever the splits are; two moduli make 62 bits, so
different ones agree by chance only (this is no protection against forgery).

Everything is an expression over longs. A line's place within its task comes from the row id of the scan; the place
of a split's first line is taken out of the split's sum again by the inverse of B.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Moduli (products fit into a long), a base for each, and a bound for the bits of a place and of a length.
PRIMES = (2**31 - 1, 2**31 - 19)
BASES = (1_000_003, 1_299_709)
PLACE_BITS, LENGTH_BITS = 33, 48
#: Bytes whose splits are merged first; at 128 MB a split these are 1,024 rows.
SPAN = 1 << 37


def power(base: int, exponent: str, prime: int, bits: int) -> Column:
    """``base ** exponent % prime`` for a column with values below ``2 ** bits``, one factor a bit."""
    found = "1L"
    for k in range(bits):
        found = f"{found} * IF({exponent} & {1 << k}L = 0, 1L, {pow(base, 1 << k, prime)}L) % {prime}L"
    return F.expr(found)


def _splits(spark: SparkSession, path: str) -> DataFrame:
    """path, start, n, h0, h1 of every split that a line begins in."""
    lines = spark.read.option("lineSep", "\n").text(path)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    found = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.xxhash64("value").alias("line"),
        place.alias("place"),
    )
    terms = [
        F.sum(F.pmod("line", F.lit(p)) * power(b, "place", p, PLACE_BITS) % p).alias(f"s{k}")
        for k, (p, b) in enumerate(zip(PRIMES, BASES, strict=True))
    ]
    sums = found.groupBy("path", "start").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"), *terms)
    back = [
        (F.col(f"s{k}") % p * power(pow(b, -1, p), "first", p, PLACE_BITS) % p).alias(f"h{k}")
        for k, (p, b) in enumerate(zip(PRIMES, BASES, strict=True))
    ]
    return sums.select("path", "start", "n", *back)


def merged(ranges: DataFrame, *keys: str) -> DataFrame:
    """Ranges (start, n, h0, h1) that follow each other within ``keys`` as one, with the smallest start."""
    before = Window.partitionBy(*keys).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    sums = [
        (F.sum(F.col(f"h{k}") * power(b, "before", p, LENGTH_BITS) % p) % p).alias(f"h{k}")
        for k, (p, b) in enumerate(zip(PRIMES, BASES, strict=True))
    ]
    return placed.groupBy(*keys).agg(F.min("start").alias("start"), F.sum("n").alias("n"), *sums)


def fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """file_name, size_bytes, lines (byte strings between line feeds), digest: of every file of a source.

    An empty file has no row, as in any binary listing. Compressed files are told apart by their content and their
    own size. One line has to fit into a task, as in any text scan.
    """
    files = spark.read.format("binaryFile").load(path)
    files = files.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("size_bytes"))
    spans = _splits(spark, path).withColumn("span", F.floor(F.col("start") / SPAN))
    whole = merged(merged(spans, "path", "span"), "path")
    digest = F.col("h0") * (1 << 31) + F.col("h1")
    name = F.element_at(F.split("path", "/"), -1).alias("file_name")
    return files.join(whole, "path").select(name, "size_bytes", F.col("n").alias("lines"), digest.alias("digest"))


def compare_fingerprints(left: DataFrame, right: DataFrame) -> DataFrame:
    """file_name and whether both sides hold the same bytes; files on one side only differ."""
    a, b = left.alias("a"), right.alias("b")
    equal = (F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("size_bytes", "lines", "digest"))
    same = F.coalesce(reduce(lambda x, y: x & y, equal), F.lit(False)).alias("same")
    return a.join(b, "file_name", "full").select("file_name", same)
