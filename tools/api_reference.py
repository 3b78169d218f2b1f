"""Write API.md: public functions and classes of the library with their
signatures and the first line of their docstrings.  Usage: python tools/api_reference.py"""

from __future__ import annotations

import importlib
import inspect
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

MODULES = [
    "strata.functions.rules",
    "strata.functions.standard",
    "strata.operators.keys",
    "strata.operators.relational",
    "strata.operators.joins",
    "strata.operators.quality",
    "strata.operators.scd",
    "strata.sources.ingest",
    "strata.sources.catalog",
    "strata.sources.sinks",
    "strata.plans.dimensions",
    "strata.plans.facts",
    "strata.plans.flows",
    "strata.session",
]


def first_line(obj) -> str:
    doc = inspect.getdoc(obj) or ""
    return doc.split("\n\n")[0].replace("\n", " ").strip()


def main() -> None:
    out = ["# API reference", "", "Generated by `tools/api_reference.py` from the code.", ""]
    for name in MODULES:
        mod = importlib.import_module(name)
        out += [f"## `{name}`", "", first_line(mod), ""]
        for attr, obj in sorted(vars(mod).items()):
            if attr.startswith("_") or getattr(obj, "__module__", None) != name:
                continue
            if inspect.isfunction(obj) or inspect.isclass(obj):
                try:
                    sig = str(inspect.signature(obj))
                except (TypeError, ValueError):
                    sig = "(...)"
                kind = "class " if inspect.isclass(obj) else ""
                out.append(f"- `{kind}{attr}{sig}`" + (f": {first_line(obj)}" if first_line(obj) else ""))
        out.append("")
    with open(os.path.join(ROOT, "API.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
