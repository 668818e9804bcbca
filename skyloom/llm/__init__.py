"""Operators for text corpora: rules, models, joins and archives over documents and pages."""
