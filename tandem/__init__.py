"""tandem — a Spark-native engine for parallel-text (bitext) data.

Every operator takes and returns Spark DataFrames or Columns; the heavy work
runs as Catalyst plans (scans, filters, joins, aggregations, windows) and only
a few per-row helpers (Unicode normalisation, greedy decoding) hop to Python
through Arrow batches.
"""

from tandem.config import CleanConfig, DataConfig, TrainConfig, TokenizerConfig  # noqa: F401

__all__ = ["CleanConfig", "DataConfig", "TrainConfig", "TokenizerConfig"]
