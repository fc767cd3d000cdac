"""Every registered query with SQL gives the SQL's rows on the smallest tables."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from tidemark.plans import catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHOSEN = sorted(catalog.ORACLE)
OTHERS = sorted(set(catalog.QUERIES) - set(catalog.ORACLE))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def in_order(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in at], sorted((tuple(r[i] for i in at) for r in rows), key=str)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DIR)
    got = in_order(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(catalog.ORACLE[name])
    want = in_order([d[0] for d in cursor.description], cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", OTHERS)
def test_query_without_sql_has_rows(spark, name):
    assert catalog.QUERIES[name](spark, DIR).count() > 0


def test_the_rest_works_without_the_llm_folders(tmp_path):
    """The library, its queries and their SQL stand without the training-data part, with or without the pipeline's file."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name, left_out in (("a", ("llm", "corpus_pipeline.py")), ("b", ("llm",))):
        copy = tmp_path / name
        shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *left_out))
        code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'book_payment' in q and set(o) <= set(q) and not any(x == 'pipeline' or x.startswith('op1') for x in q); "
                "import importlib, pkgutil, tidemark; [importlib.import_module(m.name) for m in pkgutil.walk_packages(tidemark.__path__, 'tidemark.')]; print('fine')")
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True)
        assert out.stdout.strip() == "fine", out.stderr


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
