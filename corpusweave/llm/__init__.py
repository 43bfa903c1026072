"""Training-data operators for language models; nothing outside this package imports it."""
