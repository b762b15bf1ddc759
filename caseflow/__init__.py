"""caseflow: profile, consolidate, encode and model entity event logs on Spark."""

__version__ = "0.1.0"
