"""Every query of the engine against its SQL twin on the smallest tables."""

import pytest

from lamina.plans import catalog
from tests import compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_equals_sql(spark, con, name):
    assert compare.of_spark(catalog.QUERIES[name](spark, SF)) == compare.of_sql(con, catalog.ORACLE[name])


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


def test_entry_stands_alone(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 20
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stands_without_the_llm_folder(tmp_path):
    """A copy without lamina/llm and corpus_pipeline.py imports and lists the engine's queries."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "lamina", tmp_path / "lamina", ignore=shutil.ignore_patterns("llm"))
    (tmp_path / "lamina/llm/__pycache__").mkdir(parents=True)
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.catalog.QUERIES), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert said.stdout.split() == ["True", str(len(catalog.ORACLE))], said.stderr


def test_whole_documents_are_read_for_bans(spark):
    """The trigram at the real end, by brute force."""
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = [len(w) for w in r["text"].split(" ")]
        n = len(ids)
        hits = {ids[i + 2] for i in range(max(0, n - 50), n - 2) if ids[i : i + 2] == ids[n - 2 :]} - {5} if n >= 3 else set()
        want[r["doc_id"]] = ",".join(map(str, sorted(hits)))
    assert {r["doc_id"]: r["banned"] for r in catalog.QUERIES["ngram_ban_whole"](spark, SF).collect()} == want
