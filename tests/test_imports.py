"""Only the absence of the operators for training data is passed over, not an error inside them."""

import importlib.util
import sys
from pathlib import Path

import pytest

ENTRY = Path(__file__).resolve().parents[1] / "__spark_entry__.py"


def load():
    spec = importlib.util.spec_from_file_location("entry_again", ENTRY)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


class Missing:
    """Lets one module go missing."""

    def __init__(self, name):
        self.name = name

    def find_spec(self, name, path=None, target=None):
        if name == self.name:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)


@pytest.fixture
def without(monkeypatch):
    def hide(name):
        for loaded in [m for m in sys.modules if m.startswith("highwater.llm") or m == "corpus_pipeline"]:
            monkeypatch.delitem(sys.modules, loaded)
        monkeypatch.setattr(sys, "meta_path", [Missing(name), *sys.meta_path])

    return hide


def test_the_folder_may_be_absent(without):
    without("highwater.llm")
    entry = load()
    assert entry.llm is None and set(entry.queries()) == set(entry.own_queries())


def test_a_missing_library_is_not_hidden(without):
    without("highwater.functions.skew_")
    load()
    pytest.importorskip("highwater.llm")
    without("highwater.llm.common")
    with pytest.raises(ModuleNotFoundError, match="common"):
        load()
