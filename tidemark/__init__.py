"""tidemark: change-data-capture pipelines as plain Spark DataFrame programs."""
