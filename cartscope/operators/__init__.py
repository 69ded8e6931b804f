"""Row-level and set-level operators: flatten (lenient / raw + rejects),
validation, skew-safe sequencing."""
