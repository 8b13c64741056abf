"""Operators over request lines, result lines and catalogues."""
