"""Whole workflows over many runs: locate, report, submit, apply."""
