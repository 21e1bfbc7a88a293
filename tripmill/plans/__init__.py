"""Compositions of operators: the load pipeline, the marts and what is derived from them."""
