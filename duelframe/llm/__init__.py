"""Training-data operators: near-duplicates, decontamination, scoring, mixing, scans.

Each module holds one operator with a general interface; ``queries`` derives
the contracted columns from them.  Nothing outside this subpackage imports it.
"""
