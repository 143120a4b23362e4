"""Sources: parquet tables, text files, numeric lines, manifests, streams."""

from termflow.sources.tables import TABLES, read_table
from termflow.sources.text import (in_memory, lines_of, manifest_documents,
                                   numeric_vectors, text_lines, whole_text_files)

__all__ = ["TABLES", "read_table", "in_memory", "lines_of", "manifest_documents",
           "numeric_vectors", "text_lines", "whole_text_files"]
