"""End-to-end refreshes."""
