"""Streaming jobs. The reference is batch-only; its documented incremental
load is offered as a Structured Streaming merge (see ``incremental``)."""
