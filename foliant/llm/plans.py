"""The queries of this subpackage, by module."""

from __future__ import annotations

import importlib

NAMES = ("split_queries", "packing_queries", "leakage_queries", "sentence_queries")


def modules() -> list:
    return [importlib.import_module(f"foliant.llm.{name}") for name in NAMES]
