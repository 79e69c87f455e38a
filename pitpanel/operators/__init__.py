"""DataFrame operators: every one works on a whole range of trade dates."""
