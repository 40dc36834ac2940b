"""Inputs and outputs: declared raw contracts, CSV ingest, the test-data
adapter and the table sinks."""
