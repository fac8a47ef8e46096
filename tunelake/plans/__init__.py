"""User-level entry points and the registered queries."""
