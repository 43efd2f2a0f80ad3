"""Review analytics on Spark: operators, sources, functions, plans and streaming forms."""
