"""Operators of a training-data pipeline over whole document tables. Nothing else imports this."""
