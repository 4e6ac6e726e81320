"""Operators for large training-text corpora, and the pipeline made of them.

Every operator takes DataFrames and returns DataFrames. Input tables may hold further
columns of any name; the operators read only the columns that they name. Conventions
that hold for all of them: a null text counts as empty, repeated rows are separate rows,
an empty table gives an empty result. Operators that return the input's columns replace those named like
the ones they add; names that start with ``_llm_`` are kept for their own use.
"""
