"""Streaming: intentionally empty.

The reference pipeline is batch only (no watermarks, windows over event
time, state or late data), so no streaming operators are built here.
"""
