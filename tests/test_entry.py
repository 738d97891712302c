"""The entry point where the training-data operators, or a library of theirs, are missing."""

import builtins
import contextlib
import sys
from importlib.util import find_spec

import pytest

import __spark_entry__ as entry


def without(monkeypatch, missing):
    real = builtins.__import__

    def find(name, *args, **kwargs):
        if name == missing or name.startswith(missing + "."):
            raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)
        return real(name, *args, **kwargs)

    for name in [n for n in sys.modules if n.split(".")[0] in ("corpus_pipeline", missing) or n.startswith("evenkeel.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", find)


@pytest.mark.parametrize("missing", ["corpus_pipeline", "evenkeel.llm", "xxhash"])
def test_other_queries_stay(monkeypatch, missing):
    without(monkeypatch, missing)
    # a library is missed only where the operators are there
    told = missing == "xxhash" and find_spec("corpus_pipeline") is not None
    with pytest.warns(UserWarning, match="xxhash") if told else contextlib.nullcontext():
        own = entry.queries()
    assert "e02_count_undersampling" in own and not any(n.startswith("op") for n in own) and set(entry.oracle_sql()) <= set(own)

