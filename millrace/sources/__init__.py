from millrace.sources.files import read_files, stream_files
from millrace.sources.jdbc import read_jdbc

__all__ = ["read_files", "read_jdbc", "stream_files"]
