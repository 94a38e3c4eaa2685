"""lodestar: hybrid search, learning-to-rank and monitoring as Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` transformation with an explicit
``as_of`` instant; nothing calls ``collect()`` on data that grows with the input.
"""

from lodestar.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
