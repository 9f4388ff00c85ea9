"""Generic DataFrame operators."""
