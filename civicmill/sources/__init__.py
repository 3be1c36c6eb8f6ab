"""Readers of landed files: delimited, fixed width, wide, CSV sets, pages and feeds."""
