"""Training-data operators: scans, decontamination, de-duplication, filters, tokens and chat text.

Nothing else in the library imports this subpackage.
"""
