"""Whole runs: rebuilding all outputs, and the registered table queries."""
