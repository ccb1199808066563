"""Column expressions: numbers, durations, text, and the HTML page reader."""
