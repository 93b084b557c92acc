"""Training-data operators: formatting, deduplication, filtering, sharding,
language identification and tokenization of large text tables.

Nothing else in the library imports this subpackage.  Executors need the
``tidewater`` package on their Python path (``--py-files`` on a cluster)."""
