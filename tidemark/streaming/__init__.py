"""Structured Streaming wrappers: ``foreachBatch`` bodies over the batch plans."""
