"""Column-level building blocks: ratios, units, classifiers, parsers, masking."""
