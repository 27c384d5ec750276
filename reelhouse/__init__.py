"""reelhouse — a Spark-native ratings and tagging lakehouse.

Raw rating, tag, movie and link relations are turned into typed staging
tables, a star schema (two dimensions, three facts), three analytical marts
and slowly-changing history of each mart, with data-quality checks beside
them.  Every operator is a plain ``DataFrame -> DataFrame`` function; table
I/O lives in :mod:`reelhouse.plans.tables`.
"""

from reelhouse.session import build_session, ensure_session_defaults

__all__ = ["build_session", "ensure_session_defaults"]
