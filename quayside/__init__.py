"""Port-call analytics and alerting on PySpark."""

from quayside.session import build_session, configure

__all__ = ["build_session", "configure"]
