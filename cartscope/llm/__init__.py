"""Training-data operators: deduplication, decontamination, scoring, scans, packing.

Each module holds one operator with a general interface (documents in, spans,
texts, scores or pieces out). ``queries`` registers the operators over the
``documents`` table. Nothing outside this subpackage imports it.
"""
