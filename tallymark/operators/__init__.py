"""DataFrame -> DataFrame operators; none of them depends on a table layout."""
