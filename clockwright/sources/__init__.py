"""Reading raw and processed tables, writing results."""
