"""Table operators: ``DataFrame -> DataFrame``."""
