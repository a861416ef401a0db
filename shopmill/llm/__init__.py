"""Operators for preparing training text, with their queries; nothing outside imports this package."""
