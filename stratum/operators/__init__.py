"""DataFrame -> DataFrame operators (no actions except in gates and sinks)."""
