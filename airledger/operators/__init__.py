"""DataFrame-to-DataFrame operators; batch and streaming inputs alike unless a docstring says so."""
