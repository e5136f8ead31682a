"""Jobs: operators put together, with their sources and sinks."""
