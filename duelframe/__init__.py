"""duelframe: Spark-native analytics for two-sided contests.

A contest table has one row per event with a home side, an away side, a
season and a score per side.  Every operator is a plain function from
DataFrame(s) to DataFrame with column names as arguments, so the library
runs on any table of that shape.  All heavy work is expressed with the
DataFrame / SQL API (Catalyst plans it) or with Spark ML estimators.
"""

from duelframe.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
