"""Reading the two-table model and writing results."""
