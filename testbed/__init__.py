"""Packets made of the test tables, and the registered queries over them. Not part of the library."""
