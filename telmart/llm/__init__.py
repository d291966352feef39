"""Operators for preparing training text at scale. Nothing else imports this."""
