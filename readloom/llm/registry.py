"""The queries of this package, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from importlib import import_module

MODULES = ["bpe", "token_files", "near_dedup", "substring_dedup", "decontaminate", "vp_search", "licences", "quality", "toxicity", "templates", "audit", "chat", "trie"]


def queries() -> dict:
    return {name: f for m in MODULES for name, f in import_module(f"readloom.llm.{m}").QUERIES.items()}


def oracles() -> dict[str, str]:
    return dict(import_module("readloom.llm.oracles").ORACLES)
