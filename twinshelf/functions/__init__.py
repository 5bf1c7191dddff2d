"""Column functions: text, string similarity, JSON."""
