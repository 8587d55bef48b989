"""streetflow: typical street speeds from vehicle GPS snapshots, as Spark jobs.

Every operator is a function from DataFrames to a DataFrame; nothing holds a
global session, a hard-coded path or the wall clock ("today"/"now" are
arguments).
"""

from streetflow.config import Config

__all__ = ["Config"]
