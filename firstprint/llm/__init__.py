"""Operators for preparing training text: filters, dedup, decontamination, token counts, formatting, packing."""
