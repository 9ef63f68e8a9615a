"""Operators that turn a crawl into training data. Nothing else in the library imports this package."""
