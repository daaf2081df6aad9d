"""Training-data pipeline operators: quality rules, deduplication, scans, tokenising, scoring, packing.

Nothing else in the library imports this subpackage.  ``queries.py`` holds the registered
``opN_*`` queries, one module per operator holds its general interface.
"""
