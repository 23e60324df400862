"""Per-patch operators on a growing folder of pixel files."""
