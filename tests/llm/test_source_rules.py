"""Static guards on the subpackage's source."""

from __future__ import annotations

import pathlib
import re

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[2]
SOURCES = [*sorted((ROOT / "tierwise" / "llm").glob("*.py")), ROOT / "corpus_pipeline.py"]


@pytest.mark.parametrize("pattern,why", [
    (r"localCheckpoint", "its blocks die with their executor"), (r"crossJoin|CROSS JOIN", "no cross joins"),
    (r"\.rdd\b|parallelize", "DataFrames only"), (r"tempfile|mkdtemp", "no machine-local folders"),
    (r"toPandas|\.sample\(|sampleBy", "nothing whole through the driver, no rows sampled away"),
    (r"except (Import|ModuleNotFound)Error", "import errors are not swallowed"),
])
def test_subpackage_avoids(pattern, why):
    hits = [f"{p.name}:{i}" for p in SOURCES for i, line in enumerate(p.read_text().splitlines(), 1) if re.search(pattern, line)]
    assert not hits, f"{why}: {hits}"


@pytest.mark.parametrize("module", ["pii.py", "secret_scan.py", "mixing.py", "spans.py"])
def test_native_modules_run_no_python(module):
    text = (ROOT / "tierwise" / "llm" / module).read_text()
    assert not re.search(r"mapIn|applyIn|udf\(|pandas|pyarrow|numpy", text)


def test_nothing_else_imports_the_subpackage():
    others = [p for p in (ROOT / "tierwise").rglob("*.py") if "llm" not in p.parts]
    assert not [p for p in others if re.search(r"\bllm\b", p.read_text())]
