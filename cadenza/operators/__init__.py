"""DataFrame operators and ML pipeline stages."""
