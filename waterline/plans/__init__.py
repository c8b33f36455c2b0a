"""Collection runs, reports and trends composed from the operators."""
