"""helixframe: differential expression and literature retrieval as Spark jobs.

Every operator is a function from DataFrames to DataFrames. Catalyst
expressions carry the work wherever they can; Arrow-batched pandas code
runs only for numeric kernels Spark lacks (negative-binomial fits,
erfc, eigen-decomposition of a small Gram matrix).
"""

from helixframe.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
