import ast
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_core_never_imports_llm():
    for p in (ROOT / "vernissage").rglob("*.py"):
        if "llm" in p.parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith("vernissage.llm") for n in names), p


def test_entry_has_three_functions():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert callable(e.entry)
