"""Operators for training data: truncation, scan repair, template residue, splitting, leakage, mixing, stuffing."""
