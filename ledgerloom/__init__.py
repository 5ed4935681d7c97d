"""ledgerloom: lending-portfolio analytics as Spark DataFrame, SQL and streaming jobs."""

from ledgerloom.config import Params

__all__ = ["Params"]
