"""Column expressions: cell clean-up and calendar / tenure rules."""
