"""Operators that prepare training text: formatting, archives, token counts, duplicates, language, leaks, packing."""
