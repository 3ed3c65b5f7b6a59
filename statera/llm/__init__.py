"""Training-data operators on Spark: dedup, archives, decontamination, PII and secret scans,
quality and language scoring, mixing and sharding. Nothing else in the library imports this
subpackage; ``queries.py`` registers one query per operator."""
