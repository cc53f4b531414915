"""Write the public API reference: python scripts/api_doc.py > docs/API.md"""

from __future__ import annotations

import inspect
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import tierwise  # noqa: E402
from tierwise import streaming  # noqa: E402

SECTIONS = [
    ("Sources", "tierwise.sources"),
    ("Sinks", "tierwise.sinks"),
    ("Metrics", "tierwise.functions"),
    ("Joins", "tierwise.operators.joins"),
    ("Totals", "tierwise.operators.totals"),
    ("Totals over many sets", "tierwise.operators.lattice"),
    ("User-defined combiners", "tierwise.operators.combine"),
    ("One row to many", "tierwise.operators.fanout"),
    ("Running sums", "tierwise.operators.numbering"),
    ("Validation", "tierwise.operators.quality"),
    ("Reshaping", "tierwise.operators.reshape"),
    ("Reuse", "tierwise.operators.reuse"),
    ("Plans", "tierwise.plans"),
    ("Session", "tierwise.session"),
]


def summary(obj) -> str:
    doc = inspect.getdoc(obj) or ""
    return doc.split("\n\n")[0].replace("\n", " ")


def main() -> None:
    names = sorted(n for n in tierwise.__all__ if callable(getattr(tierwise, n)) and not inspect.ismodule(getattr(tierwise, n)))
    objects = {n: getattr(tierwise, n) for n in names}
    objects.update({f"streaming.{n}": getattr(streaming, n) for n in streaming.__all__})
    print("# API reference\n")
    print("Generated by `scripts/api_doc.py` from the package's docstrings.\n")
    for title, prefix in SECTIONS:
        chosen = [(n, o) for n, o in objects.items() if getattr(o, "__module__", "").startswith(prefix)]
        if prefix == "tierwise.plans":
            chosen += [(n, o) for n, o in objects.items() if getattr(o, "__module__", "").startswith("tierwise.streaming")]
        if not chosen:
            continue
        print(f"## {title}\n")
        for name, obj in sorted(chosen):
            try:
                sig = str(inspect.signature(obj))
            except (TypeError, ValueError):
                sig = "(...)"
            print(f"### `{name}{sig}`\n\n{summary(obj)}\n")


if __name__ == "__main__":
    main()
