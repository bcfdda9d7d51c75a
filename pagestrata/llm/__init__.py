"""Operators for preparing training data, and their queries. Nothing else imports them."""
