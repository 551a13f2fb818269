"""Whole jobs: operators joined end to end."""
