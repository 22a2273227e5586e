"""Composed plans: the three sequence builders and the training plan."""
