"""Checks of the library on the shared test tables: stand-in sources, the
registered queries and their independent SQL."""
