"""What a task holds while it cuts texts into super-k-mers: it shares its executor's memory with others."""

import tracemalloc

import pyarrow as pa

from saleslake.llm import superkmers


def _scanned(texts):
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array([0] * len(texts), pa.int64()), pa.array(texts, pa.binary())],
        ["rid", "th", "text"],
    )
    found = superkmers._scan(superkmers.Units(words=True, k=50, m=8))(iter([batch]))
    return {(r["rid"], r["start"] + i) for out in found for r in out.to_pylist() for i in range(r["n"])}


def test_scan_holds_a_bounded_part_of_the_texts():
    texts = [b" ".join(b"w%d" % (i * j % 9973) for i in range(2_000)) for j in range(1, 400)]
    superkmers._power(superkmers._BASE_A, 1 << 20)  # tables that stay
    superkmers._power(superkmers._BASE_B, 1 << 20)
    batch_rows = len(texts) * (2_000 - 49)
    tracemalloc.start()
    try:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(range(len(texts)), pa.int64()), pa.array([0] * len(texts), pa.int64()), pa.array(texts, pa.binary())],
            ["rid", "th", "text"],
        )
        windows = sum(
            int(out.column("n").to_numpy().sum())
            for out in superkmers._scan(superkmers.Units(words=True, k=50, m=8))(iter([batch]))
        )
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert windows == batch_rows
    assert peak < 50 << 20


def test_every_window_of_a_text_longer_than_a_piece_is_there():
    words = superkmers.PIECE + 1_000
    texts = [b"a b", b" ".join(b"%d" % (i % 7919) for i in range(words)), b""]
    assert _scanned(texts) == {(1, i) for i in range(words - 49)}
