"""Structured Streaming form of the text-triplet source.

The reference has no streaming; its only sources are triplet text files.  This module
applies that same source incrementally: triplet files landing in a folder are appended
(exactly once, via the streaming checkpoint) to a parquet cell log, and any reader
folds the log into a matrix with the usual ``groupBy(i, j).sum(v)``.  No stream state
holds the matrix, so the stream's cost per micro-batch is the size of the new files.
"""

from .text_stream import (append_cells_log, load_cells_log, load_vector_log,  # noqa: F401
                          read_text_stream, read_text_vector_stream, rejected_lines)
