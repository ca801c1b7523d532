"""DataFrame operators: prices, instruments, metrics, windows, models, ingest, audit, questions."""
