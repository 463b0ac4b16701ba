"""Column functions on names and lines; none of them needs a user function."""
