"""edgeloom: access-log analytics expressed as Spark DataFrame and streaming jobs."""
