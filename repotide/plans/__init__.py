"""The metric tables and the normalised tables, composed from operators."""
