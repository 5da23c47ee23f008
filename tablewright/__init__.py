"""tablewright: table-driven data integration on Spark.

Configuration tables describe a process (source table or view, the chain of
named sub-queries behind the view, column mappings and targets); the library
turns them into DataFrame work: change capture, views, projections, nested
outbound documents, delivery with dead letters, sinks and run history.
"""

__version__ = "0.1.0"
