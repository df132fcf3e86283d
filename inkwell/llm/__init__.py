"""Training-data operators over document tables; nothing outside this package imports it."""
