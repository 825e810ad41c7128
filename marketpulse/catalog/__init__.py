"""The operators as named queries over the test tables, each with its SQL counterpart."""
