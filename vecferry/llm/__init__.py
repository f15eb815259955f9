"""Operators for training data: quality, duplicates, mixing, packing, token files and personal data.

Every operator reads the columns it names and no others, so extra columns of any name do no harm. A null text counts
as empty. Rows with the same ``doc_id`` and the same text are one document that is listed more than once: each of
them is returned, with the same values. A null ``doc_id`` is an identifier like any other.
"""
