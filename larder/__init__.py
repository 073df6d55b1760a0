"""larder: document, line and run analytics expressed as Spark plans."""
