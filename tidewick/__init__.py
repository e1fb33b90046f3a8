"""Market-series analytics on Spark DataFrames."""

from tidewick.session import prepare_session, scratch_path

__all__ = ["prepare_session", "scratch_path"]
