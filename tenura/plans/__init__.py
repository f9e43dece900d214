"""The layered people models, built from the generic operators."""
