"""Operators for preparing training data: near-copies, languages, quality, licences, web pages."""
