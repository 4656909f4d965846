"""rankforge: recommendation analytics as Spark DataFrame jobs.

Every operator is a function from DataFrames (plus scalar parameters) to a
DataFrame.  Nothing is collected to the driver except bounded scalars.
"""

from rankforge.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
