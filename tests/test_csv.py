from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lamina.schemas import RAW_LAYOUTS, RAW_PRIMARY_KEYS, RAW_REFERENCES, raw_columns, raw_schema
from lamina.sources.csv import _quotes, read_csv, spans_lines
from lamina.sources.tables import path_exists


@pytest.fixture
def csv(tmp_path):
    def write(text, name="t.csv"):
        path = tmp_path / name
        path.write_bytes(text.encode("utf-8"))
        return str(path)

    return write


def test_typed_by_header_name_in_any_order(spark, csv):
    path = csv("stop,start,patient,code,description\r\n"
               ",2001-02-03T04:05:06Z, ABC-1 ,7,café –\r\n")
    row = read_csv(spark, path, "devices").first()
    assert row.start == datetime(2001, 2, 3, 4, 5, 6)
    assert (row.stop, row.encounter, row.udi) == (None, None, None)
    assert (row.patient, row.description) == ("abc-1", "café –")
    assert read_csv(spark, path, "devices").schema == raw_schema("devices")


def test_zone_free_times_in_any_session_zone(spark, csv):
    path = csv("start\n2020-03-08T02:30:00Z\n")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert read_csv(spark, path, "devices").first().start == datetime(2020, 3, 8, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_quoted_empty_is_text_and_unquoted_is_null(spark, csv):
    path = csv('name,city,zip\n"",,"a ""b"", c"\n')
    row = read_csv(spark, path, "organizations").first()
    assert (row.name, row.city, row.zip) == ("", None, 'a "b", c')


def test_line_breaks_inside_quotes(spark, csv):
    plain = csv('name,city\n"a",b\n', "plain.csv")
    broken = csv('name,city\n"one\ntwo",b\nc,d\n', "broken.csv")
    assert not spans_lines(spark, plain) and spans_lines(spark, broken)
    rows = read_csv(spark, broken, "organizations").select("name", "city").collect()
    assert sorted(map(tuple, rows)) == [("c", "d"), ("one\ntwo", "b")]


def test_line_breaks_across_many_splits(spark, tmp_path):
    """Records that cross the borders of read blocks, in several files, any line end."""
    import random

    rnd, expected = random.Random(5), []
    folder = tmp_path / "organizations.csv"
    folder.mkdir()
    for part in range(3):
        end = "\r\n" if part == 1 else "\n"
        text = "name,city,zip" + end
        for i in range(120):
            name = "".join(rnd.choice(["a", "é", ",", '"', "\n", "\r\n", " "]) for _ in range(rnd.randrange(1, 90)))
            city = rnd.choice([None, "", "plain"])
            expected.append((name, city, f"{part}-{i}"))
            quoted = name.replace('"', '""')
            text += f'"{quoted}",{"" if city is None else chr(34) * 2 if city == "" else city},{part}-{i}{end}'
        (folder / f"{part}.csv").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spans_lines(spark, str(folder))
        df = read_csv(spark, str(folder), "organizations").select("name", "city", "zip")
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 20
        assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, expected))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("cut", ["90", "128m"])
def test_lines_are_gathered_where_they_are_read(spark, tmp_path, cut):
    """Records longer than a block or a batch; lines aren't shuffled, and without cut files nothing is."""
    folder = tmp_path / "organizations.csv"
    folder.mkdir()
    expected = [(f"{i}" + "\n" * (i * 7 % 41) + '"' * (i % 3), f"c{i}\n", str(i)) for i in range(60)]
    for part in range(2):
        lines = ['"{}","{}",{}'.format(n.replace('"', '""'), c, z) for n, c, z in expected[part::2]]
        (folder / f"{part}.csv").write_text("name,city,zip\n" + "\n".join(lines) + "\n" * part)
    settings = {"spark.sql.files.maxPartitionBytes": cut, "spark.sql.files.openCostInBytes": "0",
                "spark.sql.files.minPartitionNum": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "3"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df = read_csv(spark, str(folder), "organizations").select("name", "city", "zip")
        assert sorted(map(tuple, df.collect())) == sorted(expected)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert cut == "90" or "Exchange hashpartitioning" not in plan
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_multiline_files_with_other_headers_are_not_mixed(spark, tmp_path):
    folder = tmp_path / "organizations.csv"
    folder.mkdir()
    (folder / "a.csv").write_text('name,city\n"n\nn",c\n')
    (folder / "b.csv").write_text("city,name\nc,n\n")
    with pytest.raises(Exception, match="different headers"):
        read_csv(spark, str(folder), "organizations").collect()


def test_unterminated_quote_is_an_error(spark, csv):
    path = csv('name,city\na,b\n"never closed,c\nd,e\n')
    with pytest.raises(Exception, match="unterminated quoted field"):
        read_csv(spark, path, "organizations").collect()


@pytest.mark.parametrize("rest", ["a,b,c\n", '"x\ny",b,c\n', '"x\ny"\n', "a\n"])
def test_records_of_the_wrong_length_are_errors(spark, csv, rest):
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, csv("name,city\n" + rest), "organizations").select("name").collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("column,value", [("utilization", "x"), ("revenue", "1,5"), ("lat", "-"),
                                          ("utilization", '""')])
def test_bad_values_are_errors(spark, csv, ansi, column, value):
    quoted = value if value == '""' else f'"{value}"'
    path = csv(f"name,{column}\nn,{quoted}\n")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match=f"bad value for organizations.{column}"):
            read_csv(spark, path, "organizations").collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_unknown_column_is_an_error(spark, csv):
    with pytest.raises(ValueError, match="no column nope"):
        read_csv(spark, csv("name,nope\na,b\n"), "organizations")


def test_files_with_other_headers_are_not_mixed(spark, tmp_path):
    folder = tmp_path / "organizations.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("name,city\nn,c\n" * 1)
    (folder / "b.csv").write_text("city,name\nc,n\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(folder), "organizations").collect()


def test_money_rounds_half_up(spark, csv):
    row = read_csv(spark, csv("revenue\n1.235\n"), "organizations").first()
    assert row.revenue == Decimal("1.24")


def test_dates(spark, csv):
    row = read_csv(spark, csv("start,stop\n2020-01-02,\n"), "allergies").first()
    assert (row.start, row.stop) == (date(2020, 1, 2), None)


def test_paths(spark, csv, tmp_path):
    assert path_exists(spark, csv("a\n")) and not path_exists(spark, str(tmp_path / "none.csv"))


def test_layouts_are_consistent():
    assert len(RAW_LAYOUTS) == 18
    order = list(RAW_LAYOUTS)
    for child, references in RAW_REFERENCES.items():
        names = {c.name for c in raw_columns(child)}
        for column, parent in references.items():
            assert column in names
            assert order.index(parent) < order.index(child)
    for table in RAW_PRIMARY_KEYS:
        assert raw_columns(table)[0].name == "id"


def test_quotes_are_counted_without_counting_characters(spark):
    """Every byte of a file passes here twice; characters of any width beside quotes change nothing."""
    assert str(_quotes()).count("length(") == str(_quotes()).count("octet_length(") == 2
    lines = ['', '"', 'é"日"', '"😀"",""', "plain"]
    df = spark.range(1).select(F.explode(F.array(*map(F.lit, lines))).alias("value")).select("value", _quotes().alias("n"))
    assert {r["value"]: r["n"] for r in df.collect()} == {x: x.count('"') for x in lines}
