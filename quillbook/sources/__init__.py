from quillbook.sources import extracts, jdbc, tables

__all__ = ["extracts", "jdbc", "tables"]
