"""Training-data operators: quality rules, dedup, classifiers, decontamination, packing, URL
filters, language identification, resharding, toxicity and set similarity joins.

Nothing outside this subpackage imports it; `queries.py` lists its queries and SQL twins.
"""
