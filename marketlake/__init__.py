"""marketlake: multi-venue market data on Spark.

Every public function takes and returns DataFrames; nothing in the package
collects data to the driver except the small manifest and gate helpers.
"""

from marketlake.session import build_session, ensure_session

__all__ = ["build_session", "ensure_session"]
