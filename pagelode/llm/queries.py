"""Loads the modules of the operators, each of which registers its query."""

from __future__ import annotations

import importlib

from pagelode.llm.common import ORACLES, QUERIES

MODULES = ("chat", "quality", "decontamination", "packing", "rules", "simhash", "attribution", "fixity", "language", "slots",
           "histogram_packing", "whitening", "prefix_tree")

for _module in MODULES:
    importlib.import_module(f"pagelode.llm.{_module}")

__all__ = ["ORACLES", "QUERIES"]
