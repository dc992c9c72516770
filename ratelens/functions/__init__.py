"""Column expressions: text (cleaning, tokenising), numeric (rounding), buckets, time, render."""
