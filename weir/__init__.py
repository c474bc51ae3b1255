"""weir: a Spark-native engine for capturing, filtering, enriching, encoding and
checking log events, for batch tables and Structured Streaming alike.

Every operator is a DataFrame -> DataFrame transformation built from Catalyst
expressions, windows and joins. Python runs inside tasks only for the
append-aware file source and the streaming quota state.
"""

from weir.session import build_session, configure, checkpoint_dir  # noqa: F401

__all__ = ["build_session", "configure", "checkpoint_dir"]
