"""Lectern: a PySpark engine for curating question banks."""
