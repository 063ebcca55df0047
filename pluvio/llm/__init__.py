"""Operators for large text corpora (training-data preparation).

Nothing outside this subpackage imports it.  Every operator takes a DataFrame
with (some of) the columns of ``documents`` and reads the columns it needs by
name, so further columns, whatever their names, never meet its own.
"""
