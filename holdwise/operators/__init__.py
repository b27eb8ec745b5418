"""Model operators: each is a DataFrame -> DataFrame function (see README)."""
