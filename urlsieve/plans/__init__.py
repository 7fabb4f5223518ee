"""End-to-end flows."""
