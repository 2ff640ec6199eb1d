"""HTML trees, CSS selection and operators over both, on the standard library alone."""
