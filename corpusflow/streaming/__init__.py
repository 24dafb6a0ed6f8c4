"""Streaming jobs. Stateless: they run the same operators as the batch jobs."""
