"""Operators for preparing training corpora: cleaning, de-duplication, mixing, packing, archives and search."""
