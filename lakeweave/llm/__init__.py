"""Training-data operators (quality, joins, dedup, PII, HTML, BPE, WARC, decontamination).

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames; Python runs only inside tasks, over Arrow batches.
"""
