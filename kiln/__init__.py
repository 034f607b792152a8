"""kiln: post-training data preparation as Spark DataFrame jobs.

Sub-packages:
  sources    readers / writers and bindings of the driver tables
  functions  Column -> Column expressions (tokenizer pieces, graders, formats)
  operators  DataFrame -> DataFrame operators (splits, render, rollouts, ...)
  plans      registered end-to-end queries (Spark plan + DuckDB oracle SQL)
  streaming  Structured Streaming jobs (count-based batching, staleness, ...)
"""

__version__ = "0.1.0"
