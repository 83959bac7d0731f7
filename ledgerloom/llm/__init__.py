"""Training-data operators: token files, joins of near copies, quality, scans, extraction and packing.

Nothing else in the library imports this subpackage; deleting it leaves the rest whole.
"""
