"""strata: a layered real-time warehouse on Spark DataFrames and Structured Streaming.

Every transform is a plain function ``DataFrame -> DataFrame`` that serves batch
and streaming inputs alike; sinks and stateful jobs live in ``sinks`` and
``streaming``.
"""

from strata.session import checkpoint_root, configure, load_table, spread

__all__ = ["configure", "checkpoint_root", "load_table", "spread"]
