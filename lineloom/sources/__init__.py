"""Readers and writers: source trees, chunk and line stores."""
