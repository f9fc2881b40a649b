"""Named analytical queries. Each takes the log (or a roll-up), the reference instant
``as_of`` and its thresholds as keywords, and returns one lazily planned DataFrame."""
