"""Operators on streams.

There is no stream operator of its own here: projections, filters, encodings and scoring keep no
state, so they take a streaming table as it is. What a stream needs is a sink that remembers its
place, which is ``save_stream``.
"""
