"""Generic DataFrame operators used by every layer."""
