"""The library and its tests without the text operators."""

import ast
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]


def imported(path):
    for node in ast.walk(ast.parse(path.read_text())):
        if isinstance(node, ast.Import):
            yield from (a.name for a in node.names)
        elif isinstance(node, ast.ImportFrom):
            yield from (f"{node.module}.{a.name}" for a in node.names)


def test_nothing_outside_imports_the_text_operators():
    own = [p for p in [*(REPO / "jobtide").rglob("*.py"), *(REPO / "tests").glob("*.py"), REPO / "bench.py", REPO / "check.py"]
           if "llm" not in p.relative_to(REPO).parts]
    assert len(own) > 30
    for path in own:
        names = list(imported(path))
        assert not [n for n in names if "jobtide.llm" in n or "corpus_pipeline" in n], path


def test_the_entry_does_without_them(monkeypatch):
    import builtins
    import importlib

    import __spark_entry__ as entry

    real = builtins.__import__

    def without(name, *args, **kw):
        if name == "corpus_pipeline" or name.startswith("jobtide.llm"):
            raise ImportError(name)
        return real(name, *args, **kw)

    with monkeypatch.context() as m:
        m.setattr(builtins, "__import__", without)
        importlib.reload(entry)
        assert entry.texts is None and set(entry.queries()) == set(entry.oracle_sql())
    importlib.reload(entry)
    assert any(name.startswith("op") for name in entry.queries())
