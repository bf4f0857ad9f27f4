"""Column expressions: scores and features, text, responses, payloads."""
