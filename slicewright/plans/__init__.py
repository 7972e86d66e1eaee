"""The control framework: whole-table plans built from the operators."""
