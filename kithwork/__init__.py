"""Social-graph, rating and text analytics as plain Spark DataFrame functions."""
