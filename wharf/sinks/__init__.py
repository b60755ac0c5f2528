"""Sinks: envelopes to broker rows, request batches, writers."""
