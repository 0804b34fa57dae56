"""Raw inputs, dated paths and table sinks."""
