"""Column expressions: cleaning, metrics, labels, display text."""
