"""Column expressions: text, chat messages, answers and scores."""
