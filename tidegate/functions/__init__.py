"""Column expressions: text, dates, geometry and report wording."""
