"""The driver contract on the smallest given tables, where they are present."""

import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as contract  # noqa: E402
from workload.oracle import SQL  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")
COMPARED = (
    "clean_text", "token_stats", "signatures", "candidate_pairs", "exact_jaccard_pairs",
    "similar_enriched", "similar_batch", "similar_to_texts", "sweep_bands", "catalog_shelves",
    "word_histogram", "replicate",
)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL) <= set(contract.queries()) & set(contract.oracle_sql())


def comparable(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)

    def plain(value):
        if isinstance(value, float):
            return None if math.isnan(value) else round(value, 9)
        return value

    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@needs_tables
@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_its_sql(spark, name):
    tables = duckdb.connect()
    for table in ("documents", "benchmark"):
        tables.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    expected = tables.execute(contract.oracle_sql()[name])
    names = [column[0] for column in expected.description]
    df = contract.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(names)
    assert comparable(df.columns, df.collect()) == comparable(names, expected.fetchall())


@needs_tables
def test_entry_is_ordered(spark):
    similarities = [r.similarity for r in contract.entry(spark).collect()]
    assert similarities and similarities == sorted(similarities, reverse=True)


@needs_tables
def test_pair_queries_have_no_nested_loop(spark):
    for name in ("candidate_pairs", "similar_batch", "lsh_metrics", "sweep_bands"):
        plan = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


@needs_tables
def test_the_rest_imports_and_runs_without_the_llm_folders(tmp_path):
    root = Path(contract.__file__).resolve().parent
    left_out = {root / "nearkin" / "llm", root / "tests" / "llm"}

    def skipped(folder, names):
        return [n for n in names if n in (".git", "__pycache__") or Path(folder, n) in left_out]

    shutil.copytree(root, tmp_path / "repo", ignore=skipped)
    code = (
        "import __spark_entry__ as c, sys; assert 'pipeline' not in c.queries(); "
        "assert not [n for n in c.queries() if n.startswith('op')]; "
        "from pyspark.sql import SparkSession; "
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate(); "
        f"print(c.queries()['doc_stats'](s, {FOLDER!r}).count())"
    )
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=240,
        env=os.environ | {"PYTHONPATH": str(tmp_path / "repo")},
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split()[-1]) > 0
