"""The market tables bound to the given star schema, with a query and an SQL text per operator."""
