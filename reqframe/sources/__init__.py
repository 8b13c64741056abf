"""Readers for line files, id lists, blobs and catalogues, and the sinks."""
