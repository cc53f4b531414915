"""Static guards on the library source."""

from __future__ import annotations

import pathlib
import re

import pytest

# The reference's own operators; the training-data subpackage has its own rules.
SOURCE = [
    p for p in sorted((pathlib.Path(__file__).resolve().parent.parent / "tierwise").rglob("*.py")) if "llm" not in p.parts
]


@pytest.mark.parametrize(
    "pattern,why",
    [
        (r"localCheckpoint", "local checkpoints die with their executor"),
        (r"\bF\.rand\b|\brandn?\(", "non-deterministic values differ when a lost task is recomputed"),
        (r"\.sample\(|sampleBy\(", "rows are never sampled away"),
        (r"@udf|F\.udf\(|pandas_udf", "no Python UDF is needed by any operator"),
        (r"coalesce\(1\)|repartition\(1\)", "nothing is funnelled through a single task"),
    ],
)
def test_library_avoids(pattern, why):
    hits = [f"{p.name}:{i}" for p in SOURCE for i, line in enumerate(p.read_text().splitlines(), 1) if re.search(pattern, line)]
    assert not hits, f"{why}: {hits}"


def test_coverage_document_is_current():
    root = pathlib.Path(__file__).resolve().parent.parent
    doc = (root / "docs" / "COVERAGE.md").read_text()
    defined = {m for p in (root / "tests").glob("test_*.py") for m in re.findall(r"def (test_[a-z0-9_]+)", p.read_text())}
    cited = set(re.findall(r"`(test_[a-z0-9_]+)`", doc))
    assert cited <= defined, f"coverage cites missing tests: {sorted(cited - defined)}"
    from tierwise.plans import catalog

    named = set(re.findall(r"`([a-z_]+)`", doc))
    patterns = [n[:-1] for n in re.findall(r"`([a-z_]+\*)`", doc)]
    uncited = [q for q in catalog.QUERIES if q not in named and not any(q.startswith(p) for p in patterns)]
    assert not uncited, f"coverage does not cite registered queries: {uncited}"


def test_explicit_broadcasts_only_behind_the_size_check():
    hits = []
    for p in SOURCE:
        text = p.read_text()
        for m in re.finditer(r"F\.broadcast\(|\.hint\(\s*[\"']broadcast", text):
            enclosing = re.findall(r"^def (\w+)", text[: m.start()], flags=re.M)
            hits.append((p.name, enclosing[-1] if enclosing else None))
    # The salted join's hot keys are bounded by max_hot_keys, see its docstring.
    assert hits == [("joins.py", "checked_broadcast"), ("joins.py", "_salted_join")]


def test_api_reference_is_current(capsys):
    import importlib.util

    root = pathlib.Path(__file__).resolve().parent.parent
    spec = importlib.util.spec_from_file_location("api_doc", root / "scripts" / "api_doc.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    module.main()
    assert capsys.readouterr().out == (root / "docs" / "API.md").read_text(), "regenerate: python scripts/api_doc.py > docs/API.md"
