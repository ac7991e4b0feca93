"""Training-data operators: each module is one operator; ``queries`` registers them, nothing else imports this."""
