"""Operators that prepare a corpus for training.  Nothing else in the package imports this one."""
