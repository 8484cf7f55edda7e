"""Sources, sinks and column decoders (inventory S01-S08)."""
