"""Column expressions: safe naming and the JSON message contract."""
