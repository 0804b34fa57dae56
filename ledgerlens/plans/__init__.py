"""Whole jobs: staging and the full run."""
