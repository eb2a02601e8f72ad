"""talweg: rule-driven treatment of vector feature tables on Spark."""

from talweg.session import local_session, ship_package

__all__ = ["local_session", "ship_package"]
