"""All registered queries; importing this module fills the registry."""

from quayside.plans import (  # noqa: F401
    alert_queries,
    crawl_queries,
    feed_queries,
    page_queries,
    state_queries,
    stream_queries,
    text_queries,
)
from quayside.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
