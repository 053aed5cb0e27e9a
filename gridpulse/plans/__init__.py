"""User-level queries (``queries``) and the named registry over test tables
(``registry``)."""
