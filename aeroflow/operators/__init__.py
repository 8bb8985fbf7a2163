"""DataFrame operators: decode, flatten, de-duplicate, filter, reduce."""
