"""End-to-end runs, the named query registry and the independent SQL oracle."""
