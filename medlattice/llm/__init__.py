"""Training-data operators: language ID, deduplication, WARC, URL filters,
fingerprints, personal data, packing, quality and source mixing.

Nothing else in the library imports this subpackage. Its queries are in
:mod:`medlattice.llm.queries`.
"""
