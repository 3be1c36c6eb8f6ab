"""The warehouse jobs: each turns landed files and tables into declared tables."""
