"""Training-data operators: packing, dedup, decontamination, classifiers, scans.

Nothing else in the package imports this subpackage; ``queries`` registers its
queries and SQL.
"""
