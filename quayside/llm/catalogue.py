"""All queries of the subpackage; importing this module fills the registry."""

from quayside.llm import (  # noqa: F401
    alignment, cover_trees, fill_middle, line_windows, mixing, packing, pu_classifier,
    quality_rules, signature_trees, superkmers, token_trees, transducer, warc)
from quayside.llm.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
