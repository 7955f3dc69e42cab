"""Analytics over timed transcripts: segments, speaker turns, chunks and review documents as DataFrames.

Relations are keyed by recording (rec) and ordered by ord; times are whole milliseconds (BIGINT).
"""
