"""Whole jobs: metric views, the question library, and table loads end to end."""
