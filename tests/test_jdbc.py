"""Database scans, as far as they can be checked without a database: what Spark is asked to do."""

import datetime as dt
from decimal import Decimal
from unittest.mock import MagicMock

import pytest

from millrace import JdbcSource, read_jdbc
from millrace.sources.jdbc import derived_table

URL = "jdbc:oracle:thin:@host:1521/service"
LOGIN = {"user": "u", "password": "secret", "driver": "oracle.jdbc.OracleDriver"}


class Session:
    """Records the options of every reader and answers a bounds query."""

    def __init__(self, bounds=(None, None)):
        self.loads, self.tables, self.bounds = [], [], bounds

    @property
    def read(self):
        reader, seen = MagicMock(), {}
        reader.format.side_effect = lambda name: seen.update(format=name) or reader
        reader.options.side_effect = lambda **o: seen.update(o) or reader
        reader.option.side_effect = lambda k, v: seen.update({k: v}) or reader

        def load():
            self.loads.append(dict(seen))
            frame = MagicMock()
            frame.first.return_value = self.bounds
            return frame

        reader.load.side_effect = load
        reader.jdbc.side_effect = lambda url, table, **k: self.tables.append((url, table, k))
        return reader


def test_source_of_a_job():
    session = Session()
    JdbcSource(URL, "select * from sales", LOGIN, "id", 1, 9, 3).load(session)
    JdbcSource(URL, "select * from sales", LOGIN, predicates=("id < 5", "id >= 5 or id is null")).load(session)
    assert session.loads[0]["numPartitions"] == 3
    assert session.tables[0][2]["predicates"] == ["id < 5", "id >= 5 or id is null"]


def test_query_becomes_a_derived_table():
    assert derived_table(" select 1 from t ; ", "src") == "(select 1 from t\n) src"
    session = Session()
    read_jdbc(session, URL, "select * from sales;", LOGIN)
    assert session.loads == [
        {
            "format": "jdbc",
            "url": URL,
            "dbtable": "(select * from sales\n) src",
            "fetchsize": "10000",
            "oracle.jdbc.timezoneAsRegion": "false",
            "oracle.net.disableOob": "true",
            **LOGIN,
        }
    ]


def test_options_override_defaults():
    session = Session()
    read_jdbc(session, "jdbc:postgresql://h/d", "select 1", {"fetchsize": 5, "queryTimeout": 9}, fetchsize=7)
    assert session.loads[0]["fetchsize"] == "5"
    assert session.loads[0]["queryTimeout"] == "9"
    assert not [key for key in session.loads[0] if key.startswith("oracle")]


def test_partitions_with_bounds():
    session = Session()
    read_jdbc(session, URL, "select * from sales", LOGIN, "id", 1, 1000, 16)
    asked = session.loads[-1]
    assert (asked["partitionColumn"], asked["lowerBound"], asked["upperBound"], asked["numPartitions"]) == (
        "id", "1", "1000", 16,
    )


def test_missing_bounds_are_asked_for():
    session = Session(bounds=(5, 905))
    read_jdbc(session, URL, "select * from sales", LOGIN, "id", num_partitions=4)
    assert session.loads[0]["dbtable"] == "(select min(id) lo, max(id) hi from (select * from sales\n) src\n) ends"
    assert (session.loads[1]["lowerBound"], session.loads[1]["upperBound"]) == ("5", "905")
    session = Session(bounds=(5, 905))
    read_jdbc(session, URL, "select * from sales", LOGIN, "id", lower=0, num_partitions=4)
    assert (session.loads[1]["lowerBound"], session.loads[1]["upperBound"]) == ("0", "905")


@pytest.mark.parametrize(
    ("found", "bounds"),
    [
        ((Decimal("1.0000000000"), Decimal("904.5000000000")), ("1", "905")),
        ((-0.5, 2.5), ("-1", "3")),
        ((dt.date(2024, 1, 1), dt.date(2024, 6, 9)), ("2024-01-01", "2024-06-09")),
        ((dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 9, 1, 2, 3, 4)), ("2024-01-01 00:00:00", "2024-06-09 01:02:03.000004")),
    ],
)
def test_bounds_of_any_key(found, bounds):
    session = Session(bounds=found)
    read_jdbc(session, URL, "select * from sales", LOGIN, "id", num_partitions=4)
    assert (session.loads[1]["lowerBound"], session.loads[1]["upperBound"]) == bounds


def test_no_keys_at_all_is_one_partition():
    session = Session()
    read_jdbc(session, URL, "select * from sales", LOGIN, "id", num_partitions=4)
    assert "partitionColumn" not in session.loads[1]


def test_predicates_for_uneven_keys():
    session = Session()
    conditions = [f"mod(ora_hash(id), 8) = {i}" for i in range(8)]
    read_jdbc(session, URL, "select * from sales", LOGIN, predicates=conditions)
    (url, table, rest), = session.tables
    assert (url, table, rest["predicates"]) == (URL, "(select * from sales\n) src", conditions)
    assert rest["properties"]["fetchsize"] == "10000" and rest["properties"]["user"] == "u"


@pytest.mark.parametrize(
    "wrong",
    [
        {"lower": 1},
        {"num_partitions": 4},
        {"partition_column": "id"},
        {"predicates": []},
        {"predicates": ["a = 1"], "partition_column": "id", "num_partitions": 2},
    ],
)
def test_incomplete_partitioning_is_refused(wrong):
    with pytest.raises(ValueError):
        read_jdbc(Session(), URL, "select 1", LOGIN, **wrong)


def test_nothing_secret_is_printed(capfd):
    read_jdbc(Session(), URL, "select 1", LOGIN)
    shown = repr(JdbcSource(URL, "select 1", LOGIN))
    assert "secret" not in shown and "host" not in shown
    out, err = capfd.readouterr()
    assert "host" not in out + err and "secret" not in out + err
