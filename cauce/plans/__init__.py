"""The pipeline's tables, one function each, and the jobs that build them."""
