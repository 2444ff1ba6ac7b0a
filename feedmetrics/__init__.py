"""feedmetrics: access-log and sensor-feed analytics on Spark DataFrames.

Sub-packages:
  functions  column expressions (no actions, no DataFrames)
  sources    readers for logs, dictionaries, documents, feeds and topics
  operators  DataFrame -> DataFrame building blocks (parse, validate, join, aggregate)
  sinks      batch writers (reports, routed CSV, topic publishing)
  streaming  Structured Streaming sources, sinks and stateful queries
  plans      the registered queries: driver tables -> operators -> result DataFrame
"""

__version__ = "0.1.0"
