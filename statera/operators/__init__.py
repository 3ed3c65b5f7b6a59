"""Relational operators of the reports, each ``DataFrame(s) + parameters -> DataFrame``."""
