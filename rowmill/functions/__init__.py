"""Column helpers, scalar functions, exact quantiles and hash ordering."""
