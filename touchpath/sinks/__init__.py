"""Table, results and report writers."""
