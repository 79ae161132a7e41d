"""Operators for preparing the text of a training corpus; each module states its rules in its docstring."""
