"""crease: Spark-native profiling, cleaning, contest-history and modelling operators.

Every public operator takes a DataFrame (plus column names as parameters) and
returns a lazy DataFrame.  Catalyst plans the work; nothing large is collected
to the driver.
"""

from crease.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
