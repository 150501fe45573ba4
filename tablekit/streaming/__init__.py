"""Streaming use of the batch operators.

The reference has no streaming sources, watermarks or state. The operators
in this package are plain ``DataFrame -> DataFrame`` functions, so the
stateless ones (projection, filters, text expressions) and the aggregations
apply unchanged to a streaming DataFrame; ``incremental`` shows the line
source and word count (S01 + A06) run as a Structured Streaming query.
"""

from .incremental import word_count_stream

__all__ = ["word_count_stream"]
