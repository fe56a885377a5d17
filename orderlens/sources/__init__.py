"""File sources and sinks, and the mapping from the given tables."""
