"""DataFrame operators of the validation, counting, publication and status work."""
