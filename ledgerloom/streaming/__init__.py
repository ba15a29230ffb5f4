"""Bounded streams over change feeds, with sinks that may run a batch again."""
