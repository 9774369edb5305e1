"""starloom: weave raw education-research files into a star schema on Spark.

Everything here maps DataFrames to DataFrames.  The identifiers in docstrings
"""

from starloom.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
