"""Every query of the library against its DuckDB oracle on the small tables, and the driver's entry points."""

import builtins
import sys

import pytest

import __spark_entry__ as E
from reviewlens.plans.catalog import REGISTRY
from reviewlens.plans.oracle import ORACLE
from tests.oracle_check import compare, duck

NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(REGISTRY)
    assert set(REGISTRY) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, sf_dir, name):
    r = compare(spark, con, sf_dir, name, REGISTRY[name], ORACLE[name])
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "prediction"]
    assert df.count() > 0


@pytest.mark.parametrize("missing", ["corpus_pipeline", "reviewlens.llm", "ahocorasick"])
def test_library_queries_stay_without_the_subpackage(monkeypatch, missing):
    """A missing folder or dependency of the subpackage takes none of the library's queries along."""
    plain = builtins.__import__

    def blocked(name, globals=None, locals=None, fromlist=(), level=0):
        if name == missing or name.startswith(missing + ".") or (missing == "ahocorasick" and name.startswith("reviewlens.llm")):
            raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)
        return plain(name, globals, locals, fromlist, level)

    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("reviewlens.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", blocked)
    assert set(E.queries()) == set(REGISTRY)
    assert set(E.oracle_sql()) == set(ORACLE)
