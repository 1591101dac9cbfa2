"""Column expressions (no UDFs): text cleaning, list-literal parsing, banding."""
