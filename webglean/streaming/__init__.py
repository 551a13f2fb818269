"""Snapshots that arrive over time. The page steps need no state, so they run unchanged."""
