"""Column expressions: text, URLs, codes, labels, lists."""
