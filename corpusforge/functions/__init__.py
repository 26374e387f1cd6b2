"""Column builders: text functions, JSON decoding and the reward library."""
