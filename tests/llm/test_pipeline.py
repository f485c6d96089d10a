"""The pipeline against the plain versions of its stages, and the registered SQL."""

import pytest

import corpus_pipeline
from saleslake.llm import queries
from tests import oracle_compare as oc
from tests.llm import brute
from tests.llm.test_operators import key, rows_of

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    rows = [r for r in rows if brute.quality(r[1])[-1]]
    rows = [r for r, link in zip(rows, brute.linked(rows), strict=True) if link[0] == link[2]]
    cut = brute.substrings(rows, 50)
    rows = [(d, " ".join(c[4]) if c[2] else t, s) for (d, t, s), c in zip(rows, cut, strict=True)]
    rows = [r for r, m in zip(rows, brute.mix(rows), strict=True) for _ in range(m[4])]
    expected = sorted(((d, *brute.bpe(t)) for d, t, _ in rows), key=key)
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert rows_of(corpus_pipeline.run(spark, SF), *names) == expected


def test_stages_keep_the_columns(spark, table, messy):
    docs = table(messy)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    empty = table([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    found = oc.spark_rows(queries.QUERIES[name](spark, SF))
    assert oc.differences(found, oc.duckdb_rows(oc.connect(SF), queries.SQL[name])) is None


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_the_package_works_from_a_zip(tmp_path):
    """As with --py-files; without its license texts only the training-data queries are gone."""
    import subprocess
    import sys
    import zipfile
    from pathlib import Path

    root = Path(__file__).parents[2]
    for name, without in (("whole.zip", None), ("part.zip", "license_texts")):
        with zipfile.ZipFile(tmp_path / name, "w") as packed:
            for file in [root / "__spark_entry__.py", root / "corpus_pipeline.py", *(root / "saleslake").rglob("*")]:
                if file.suffix in (".py", ".txt") and (without is None or without not in file.parts):
                    packed.write(file, file.relative_to(root))
        code = "import __spark_entry__ as e; print(len(e.queries()), 'op1_license_scan' in e.queries())"
        found = subprocess.run(
            [sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path / name), "PATH": ""},
            capture_output=True, text=True, check=True,
        )
        n, has = found.stdout.split()
        assert int(n) > 180 and has == str(without is None)
