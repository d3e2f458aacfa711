"""Every named query against its SQL in DuckDB, on the smallest tables."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import check
from matchmill.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_agrees_with_sql(spark, duck, name):
    assert check.compare(spark, SF, name, duck).startswith("ok")


def test_every_query_has_sql():
    assert set(catalog.oracle_sql()) == set(catalog.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("module", ["ahocorasick", "corpus_pipeline", "matchmill.llm", "public_tokenizers"])
def test_other_queries_load_without_what_the_optional_part_needs(module):
    code = f"import sys; sys.modules[{module!r}] = None; import __spark_entry__ as e; print(len(e.queries()), 'op1_url_filter' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(entry.__file__), check=True)
    assert out.stdout.split() == [str(len(catalog.queries())), "False"]
