"""File formats shared by readers and writers."""

from __future__ import annotations

FORMATS = ("csv", "json", "parquet")

# Stands for null when a CSV file is parsed. It is made of private-use characters, so that a
# quoted empty field stays an empty string and only an unquoted one becomes null.
CSV_NULL = "\ue000null\ue000"

# Six fraction digits, as Spark's own default for text files stops at milliseconds, and an offset
# with seconds where a zone has them, which is so for local mean times of the past.
TIMESTAMP_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def checked_format(fmt: str) -> str:
    name = fmt.lower()
    if name not in FORMATS:
        raise ValueError(f"Unsupported file format: {fmt!r}; expected one of {', '.join(FORMATS)}")
    return name
