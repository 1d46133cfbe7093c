"""Column expressions: safe arithmetic, keys, URLs, geography, JSON and calendar functions."""
