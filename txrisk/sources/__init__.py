"""Schema, loading, the clean view, derived fixtures and result sinks."""
