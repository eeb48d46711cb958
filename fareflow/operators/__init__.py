"""Table operators: ``DataFrame -> DataFrame`` functions for ``df.transform``."""
