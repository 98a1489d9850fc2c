"""Structured Streaming use of the row-local operators.

The original job is batch only.  Its row-local steps (keyed fault
injection, sentinel cleaning, id drop, row filters, target encoding and the
feature projection) are deterministic projections and filters, so they run
unchanged on a streaming DataFrame.  Steps that need the whole table (the
sparse-column drop, dedup, the quantile cap, fitting) stay batch: their
result (dropped columns, cap values, a fitted ``PipelineModel``) is computed
on a batch table and then applied to the stream.
"""

from curata.streaming.rowwise import clean_stream, score_stream

__all__ = ["clean_stream", "score_stream"]
