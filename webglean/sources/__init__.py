"""Where tables come from and where reports go."""
