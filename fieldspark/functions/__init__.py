"""Column -> Column helpers; all of them stay inside Catalyst expressions."""
