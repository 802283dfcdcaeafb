"""Files in, files out."""
