"""Column expressions: text, codes and probabilities."""
