"""Column expressions: tokens, stop words, stems and score terms."""
