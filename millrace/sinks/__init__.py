from millrace.sinks.files import WriteResult, WriteVerificationError, write_files

__all__ = ["WriteResult", "WriteVerificationError", "write_files"]
