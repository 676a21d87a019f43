"""gridmend: Spark-first repair and preparation of regularly sampled meter data."""
