"""Column -> Column functions: text, numbers, dates, labels, payload access."""
