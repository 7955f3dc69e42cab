"""Column expressions: clocks, text, URLs, edit distances."""
