"""rillflow: keyed stream and table analytics on Spark DataFrames.

Every query is a function from DataFrame(s) to a DataFrame. Where Spark allows it the
same function serves a batch DataFrame and a streaming one; the sink is the caller's.
"""

from rillflow.session import ensure_checkpoint_dir, local_session, scratch_path

__all__ = ["local_session", "ensure_checkpoint_dir", "scratch_path"]
