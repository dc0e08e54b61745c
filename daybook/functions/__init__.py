"""Column expressions: day keys of rows and of file names."""

from daybook.functions.keys import day_key, file_key

__all__ = ["day_key", "file_key"]
