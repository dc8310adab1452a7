"""Sinks. Writing is done by the executors; nothing passes the driver."""
