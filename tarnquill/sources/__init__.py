"""Tables in, tables out."""

from tarnquill.sources.tables import cell_safe, corpus_parts, docx_paragraphs, read_csv_strings, register_views, table, typed_csv, write_parts

__all__ = ["cell_safe", "corpus_parts", "docx_paragraphs", "read_csv_strings", "register_views", "table", "typed_csv", "write_parts"]
