"""DataFrame -> DataFrame operators that the result tables and read-side queries share."""
