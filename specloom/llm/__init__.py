"""Operators for training data made with language in mind; nothing else imports them."""
