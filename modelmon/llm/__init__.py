"""Operators for preparing training text: licences, secrets, near copies, tokens, leaks, quality, mixtures, archives, pages."""
