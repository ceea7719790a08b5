"""Column functions: text cleaning, dates and small numeric rules."""
