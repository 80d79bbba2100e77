"""Per-batch job plans composed from the operators, and the registry of checks."""
