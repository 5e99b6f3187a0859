"""Operators of a training-data pipeline: quality, decontamination, language
ID, vector search, HTML extraction, toxicity, BPE, near-duplicate detection,
licence scans and repeated-passage removal.

Every operator takes and returns DataFrames.  Models are small numpy arrays
fitted on the driver from a bounded sample (the bound is a parameter); all
scoring, hashing, grouping and joining runs in Spark tasks.
"""
