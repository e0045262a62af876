"""Column expressions: text, sentiment, dates, HTML fields."""
