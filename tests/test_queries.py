"""Every registered query against its SQL on the smallest tables, and the optional subpackage's absence."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from maskwright.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows(columns, data):
    def plain(v):
        if isinstance(v, float):
            return round(v, 6) + 0.0
        return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = catalogue.QUERIES[name](spark, sf_dir)
    want = duck.execute(catalogue.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    got, want = rows(df.columns, [tuple(r) for r in df.collect()]), rows(columns, want.fetchall())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert all(x == y or isinstance(x, float) and x == pytest.approx(y, abs=2e-6) for x, y in zip(a, b)), (a, b)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_runs(spark, sf_dir, name):
    assert catalogue.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_works_without_the_optional_subpackage(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e\nassert 'faces_gap_fill' in e.queries() and not any(k.startswith('op') or k == 'pipeline' for k in e.queries())\nassert e.oracle_sql()\n"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True)
