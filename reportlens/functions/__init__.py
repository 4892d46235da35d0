"""Column -> Column helpers and plain-data word lists."""
