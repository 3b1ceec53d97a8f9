"""kestrel: batch analytics operators expressed as Spark DataFrame plans.

Every public operator takes DataFrames (and plain Python parameters) and
returns a DataFrame.  Nothing is collected to the driver; the work is left
to Catalyst, whole-stage codegen, shuffles and adaptive query execution.
"""

from kestrel.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
