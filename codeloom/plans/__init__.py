"""Training and scoring jobs composed from the operators."""
