"""Row-level operators: admission, inference, coercion, observability."""
