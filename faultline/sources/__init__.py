from faultline.sources import readers, tables, writers

__all__ = ["readers", "tables", "writers"]
