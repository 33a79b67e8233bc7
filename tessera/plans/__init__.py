"""Query compositions: catalogue methods over the operators, and the
stand-in queries over the generated test tables."""
