"""Streaming behaviours: limits and breakers on the driver, keyed state, micro-batch pipelines."""
