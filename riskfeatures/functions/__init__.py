"""Column helpers: text cleaning, dates and fiscal calendar, arithmetic."""
