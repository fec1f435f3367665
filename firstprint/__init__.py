"""Revision-aware, no-look-ahead analytics over periodic releases, on PySpark."""
