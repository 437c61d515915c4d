"""The registered queries, each with its oracle."""

from millrace.workload import changes, columns, files, joins, reports, streams, text

CASES = {**reports.CASES, **columns.CASES, **files.CASES, **text.CASES, **joins.CASES, **changes.CASES, **streams.CASES}
