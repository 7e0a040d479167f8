"""Files that the engine writes."""
