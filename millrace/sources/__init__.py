"""Where data comes from and where results are written."""
