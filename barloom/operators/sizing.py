"""Bounds of what is broadcast."""

# Largest side that is broadcast, and what a row takes besides its columns.
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 64
