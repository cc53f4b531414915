"""Streaming: incremental totals over arriving fact files.

The exercise reads bounded files, and no stream operator of its own exists;
nothing here adds one. What Structured Streaming adds is delivery: fact files
that keep arriving in a folder are turned, micro-batch by micro-batch, into
the partial rows of ``operators.totals.partial_totals`` and appended to a
stored partial table, from which ``totals_from_partials`` rolls up the totals
at any time. See ``partials.stream_partials``.
"""

from .partials import read_partials, stream_partials

__all__ = ["read_partials", "stream_partials"]
