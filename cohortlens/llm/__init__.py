"""Operators for preparing training text: scans, de-duplication, filters, mixing and packing."""
