"""Column builders: encodings, bands, ratios, p-values."""
