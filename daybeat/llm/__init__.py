"""Operators for text corpora and vectors on the way to training data; nothing else imports this."""
