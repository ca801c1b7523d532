"""Jobs put together from operators, and the catalogue of checked queries."""
