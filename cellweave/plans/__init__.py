"""End-to-end plans and the named queries."""
