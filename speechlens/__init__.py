"""speechlens: Spark-native retrieval and text analytics over dated, attributed texts.

Sub-packages: ``sources`` (scans and sinks), ``functions`` (column
expressions and sizing helpers), ``operators`` (the jobs), ``plans``
(build-once artifacts and the registered queries), ``streaming`` (search of
a query stream).
"""

__version__ = "0.1.0"
