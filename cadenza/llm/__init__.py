"""Training-data operators: deduplication, filtering, packing, tokenising.

Nothing else in the library imports this subpackage. Every operator takes
DataFrames and returns DataFrames; ``registry`` lists the queries.

Documents. An operator reads ``doc_id`` and ``text`` and ignores every other
column, so extra columns with clashing names do no harm. A null text counts
as the empty text. Rows that share a ``doc_id`` are handled row by row.
"""
