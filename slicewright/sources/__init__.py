"""Readers.  Each returns a lazy DataFrame, so filters and pruning reach the scan."""
