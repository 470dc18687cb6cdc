"""Plans: the table-level jobs built from functions and operators."""
