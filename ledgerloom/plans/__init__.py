"""Compositions of operators: the portfolio, its reports, checks and refresh."""
