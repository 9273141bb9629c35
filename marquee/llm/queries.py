"""Importing this module registers every query of the subpackage."""

from marquee.llm import bpe, decontaminate, html_text, license_scan, ngram_join, passage_chains, piece_counts, quality_rules, sparse_suffixes, spelling_variants, token_files, toxicity, whitening  # noqa: F401
from marquee.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
