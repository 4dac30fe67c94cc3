"""DataFrame -> DataFrame transformations; no I/O happens here."""
