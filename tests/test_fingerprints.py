"""Fingerprints against the bytes themselves, for any cut into splits."""

import pytest
import xxhash

from saleslake.sources import fingerprints
from saleslake.sources.fingerprints import BASES, PRIMES, compare_fingerprints, fingerprint


def plain(content: bytes) -> tuple[int, int, int]:
    """size, lines, digest"""
    lines = content.split(b"\n")
    if not lines[-1]:
        lines.pop()
    hashes = [xxhash.xxh64_intdigest(x, seed=42) for x in lines]
    signed = [h - 2**64 if h >= 2**63 else h for h in hashes]
    sums = [sum(h % p * pow(b, k, p) for k, h in enumerate(signed)) % p for p, b in zip(PRIMES, BASES, strict=True)]
    return len(content), len(lines), (sums[0] << 31) + sums[1]


FILES = {
    "lines": b"".join(b"%d,some text,%d\n" % (k, k * k) for k in range(3_000)),
    "no_end": b"a\nb\n\nc",
    "one_feed": b"\n",
    "feeds": b"\n" * 500,
    "returns": b"a\r\nb\rc\r\n" * 200,
    "no_text": bytes(range(256)) * 30,
    "equal_lines": b"same line\n" * 4_000,
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    place = tmp_path_factory.mktemp("bytes")
    for name, content in FILES.items():
        (place / f"{name}.txt").write_bytes(content)
    return place


@pytest.mark.parametrize("split", [64, 1_000, 1 << 20])
def test_splits_make_no_difference(spark, folder, monkeypatch, split):
    monkeypatch.setattr(fingerprints, "SPAN", 5_000)
    settings = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = {r["file_name"]: tuple(r)[1:] for r in fingerprint(spark, str(folder)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for name, content in FILES.items():
        assert found[f"{name}.txt"] == plain(content), name


def test_any_other_bytes_differ(spark, tmp_path):
    content = b"first\nsecond\nthird\nfourth\n" * 50
    variants = {
        "copy": content,
        "reordered": b"second\nfirst\nthird\nfourth\n" + content[26:],
        "returns": content.replace(b"\n", b"\r"),
        "one return": content[:5] + b"\r" + content[6:],
        "no last feed": content[:-1],
        "feed moved": b"first\nsecon\ndthird\nfourth\n" + content[26:],
        "bit": content[:700] + bytes([content[700] ^ 1]) + content[701:],
        "not utf-8": content[:700] + b"\x80" + content[701:],
        "not utf-8 either": content[:700] + b"\x81" + content[701:],
        "mark": b"\xef\xbb\xbf" + content[3:],
    }
    frames = {}
    for name, changed in variants.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "data.csv").write_bytes(changed)
        frames[name] = [tuple(r) for r in fingerprint(spark, str(tmp_path / name)).collect()]
    assert len({rows[0] for rows in frames.values()}) == len(variants)
    schema = "file_name string, size_bytes long, lines long, digest long"
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "data.csv").write_bytes(content)
    (tmp_path / "more" / "other.csv").write_bytes(content)
    frame = spark.createDataFrame(frames["copy"], schema)
    same = compare_fingerprints(frame, fingerprint(spark, str(tmp_path / "more"))).collect()
    assert {r["file_name"]: r["same"] for r in same} == {"data.csv": True, "other.csv": False}
    differ = compare_fingerprints(frame, spark.createDataFrame(frames["reordered"], schema)).first()
    assert not differ["same"]
