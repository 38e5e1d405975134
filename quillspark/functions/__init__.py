"""Scalar functions: column in, column out, built-in expressions but for the HTML renderer and the character count."""
