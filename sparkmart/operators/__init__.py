"""Table operators: slicing, landing, de-duplication, merging, medians, sampling."""
