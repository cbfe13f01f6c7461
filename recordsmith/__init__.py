"""recordsmith: Spark-native data work around extraction records and training corpora.

Layers:
  functions/  Column -> Column expressions (parse, canonicalize, flatten, score, render)
  operators/  DataFrame -> DataFrame operators (scoring, splits, chat, pairs, reports)
  sources/    readers (driver tables, JSONL corpora, candidates, logs, reports)
  sinks/      writers (split JSONL, dataset card, reports, pairs)
  streaming/  Structured Streaming jobs built from the same column functions
  plans/      the registered queries and their DuckDB oracle SQL
"""

from recordsmith.session import build_session, configure, checkpoint_root

__all__ = ["build_session", "configure", "checkpoint_root"]
