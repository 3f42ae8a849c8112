"""Scalar functions: contract checks, tokens, redaction."""
