"""Column expressions: text, exact decimals and business labels."""
