"""siftweb: web-page search analytics on Spark.

Pages -> nodes -> link graph -> iterative rank -> boolean keyword search,
written as DataFrame / Column expressions and Structured Streaming jobs.
"""

from siftweb.session import build_session, checkpoint_dir, read_table

__all__ = ["build_session", "checkpoint_dir", "read_table"]
