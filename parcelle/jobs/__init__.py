"""Command-line jobs for spark-submit: thin wrappers around plans, sources and the stream."""
