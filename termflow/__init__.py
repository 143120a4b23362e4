"""termflow: document-term analytics and topic scoring on Spark.

Packages: ``functions`` (column expressions), ``sources`` (readers),
``operators`` (DataFrame → DataFrame steps), ``plans`` (registered queries
and their SQL oracle), ``streaming`` (Structured Streaming jobs), ``sinks``.
"""

__version__ = "0.1.0"
