"""Incremental processing: checkpoints, plans of what to do again, and their streaming twins."""
