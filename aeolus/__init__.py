"""aeolus — Spark-native medallion engine for weather and road-traffic feeds.

Layers: ``sources`` (scans and fixture views), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame steps for Bronze, Silver,
Gold, features and models), ``plans`` (composed jobs, query catalog),
``sinks`` (writers), ``streaming`` (Structured Streaming forms).
"""

__version__ = "0.1.0"
