"""Column expressions: text, keys, HTML, answers, scores."""
