"""polyvox: opinion and deliberation analytics on Spark.

Statements, vote logs, topics, arguments and labelled argument/statement
edges are Spark DataFrames keyed by ``dataset``; every operator is a
``DataFrame -> DataFrame`` function so many datasets run in one job.
"""

from polyvox.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
