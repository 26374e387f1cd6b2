"""Reading source tables and writing benchmark files."""
