"""The order queries are registered whatever becomes of the optional ones."""

import importlib
import sys

import pytest

import __spark_entry__ as registry
from orderflow.plans.oracles import all_oracles
from orderflow.plans.queries import all_queries


@pytest.fixture
def reload():
    yield lambda: importlib.reload(registry)
    for name in [n for n, module in sys.modules.items() if module is None]:
        del sys.modules[name]
    importlib.reload(registry)


@pytest.mark.parametrize("absent", ["orderflow.llm.queries", "corpus_pipeline"])
def test_without_the_optional_queries(reload, absent, caplog):
    sys.modules[absent] = None
    found = reload()
    assert found.queries().keys() == all_queries().keys()
    assert found.oracle_sql().keys() == all_oracles().keys()
    assert "left out" in caplog.text


def test_other_errors_are_not_hidden(reload, monkeypatch):
    pytest.importorskip("corpus_pipeline")

    class Broken:
        def __getattr__(self, name):
            raise RuntimeError("broken module")

    monkeypatch.setitem(sys.modules, "corpus_pipeline", Broken())
    with pytest.raises(RuntimeError, match="broken module"):
        reload()
