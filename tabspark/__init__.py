"""tabspark: tabular profiling, preparation, training and scoring on Spark.

Every operator takes and returns DataFrames; the caller owns the session.
"""

from . import functions, operators, plans, sources, streaming
from .operators import *  # noqa: F401,F403
from .session import ensure_checkpoint_dir, local_session
from .sources import load_history, load_model, load_table, save_history, save_model, save_run

__version__ = "0.1.0"
