"""Part of larder; see README.md."""
