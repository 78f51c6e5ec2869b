"""Whole queries: the engine's own flow over text blocks, and each operator on shared tables with its SQL twin."""
