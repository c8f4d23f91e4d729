"""Game-archive and usage analytics as Spark DataFrame operators.

Every public operator takes DataFrames (or Columns) and returns DataFrames (or
Columns); nothing is evaluated until the caller writes or collects.  Row IDs in
"""

from rookery.session import build_session, configure, scratch_path

__all__ = ["build_session", "configure", "scratch_path"]
