"""Operators of a training-data pipeline, one module each; nothing else imports this package."""
