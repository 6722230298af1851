from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows_of
from tallyfield.operators.dims import checked_dimension
from tallyfield.plans import suite
from tallyfield.sources import readers, rejects, schemas
from tallyfield.sources.reports import write_report
from tallyfield.sources.states import read_state_file, state_table


def kinds(schema):
    return Counter(f.dataType.simpleString() for f in schema.fields)


def test_schema_sizes_and_types():
    assert kinds(schemas.PERSONS) == {"int": 196, "float": 72, "string": 19}
    assert kinds(schemas.INCIDENTS) == {"int": 1, "float": 12, "boolean": 13, "string": 20}
    assert kinds(schemas.COVERAGE) == {"int": 7, "bigint": 1, "float": 2, "string": 5}
    assert all(f.nullable for s in readers.SCHEMAS.values() for f in s.fields)


def test_person_columns_in_file_order():
    names = schemas.PERSONS.names
    assert len(names) == len(set(names)) == 287
    assert names[:7] == ["RT", "SERIALNO", "DIVISION", "SPORDER", "PUMA", "REGION", "ST"]
    assert names[129:133] == ["WAOB", "FAGEP", "FANCP", "FCITP"]
    assert names[206:208] == ["FYOEP", "PWGTP1"] and names[-1] == "PWGTP80"
    for text in ("FHINS3C", "PINCP", "ST", "NOP"):
        assert schemas.PERSONS[text].dataType.simpleString() == "string"


def test_state_tables(spark, tmp_path):
    assert state_table(spark).count() == 52
    small = state_table(spark, territories=False)
    assert small.count() == 51 and small.filter("StateAbbr = 'PR'").count() == 0
    assert rows_of(small.filter("ST = '11'")) == [("11", "DC", "District of Columbia")]
    path = tmp_path / "states.txt"
    path.write_text("STATE|STUSAB|STATE_NAME|STATENS\n01|AL|Alabama|1\n78|VI|Virgin Islands|2\n")
    assert rows_of(read_state_file(spark, str(path))) == [("01", "AL"), ("78", "VI")]


def incident_line(**given):
    return ",".join(given.get(n, "") for n in schemas.INCIDENTS.names)


def test_csv_quotes_and_bad_cells(spark, tmp_path):
    path = tmp_path / "incidents.csv"
    lines = [
        ",".join(schemas.INCIDENTS.names),
        incident_line(
            ID="A-1", Severity="2", Description='"He said ""hi"", ok"', Street="Main", Stop="True"
        ),
        incident_line(ID="A-2", Severity="2.0", Street="Side", Stop="yes"),
    ]
    path.write_text("\n".join(lines) + "\n")
    df = readers.read_typed_csv(spark, str(path), schemas.INCIDENTS)
    assert rows_of(df.select("ID", "Severity", "Description", "Street", "Stop")) == [
        ("A-1", 2, 'He said "hi", ok', "Main", True),
        ("A-2", None, None, "Side", None),
    ]


def test_long_block_code(spark, tmp_path):
    path = tmp_path / "coverage.csv"
    row = {"LogRecNo": "1.5", "BlockCode": "010010201001000", "ProviderName": "P"}
    line = ",".join(row.get(n, "") for n in schemas.COVERAGE.names)
    path.write_text(",".join(schemas.COVERAGE.names) + "\n" + line + "\n")
    df = readers.read_typed_csv(spark, str(path), schemas.COVERAGE)
    assert rows_of(df.select("LogRecNo", "ProviderName", "BlockCode")) == [
        (None, "P", 10010201001000)
    ]


def test_union_needs_equal_schemas(frame):
    a = frame([(1, "x")], "k int, v string")
    b = frame([(2, "y")], "k int, v string")
    assert rows_of(readers.union_same_schema(a, b, a)) == [(1, "x"), (1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="frame 3"):
        readers.union_same_schema(a, b, frame([("2", "y")], "k string, v string"))


@pytest.fixture
def data_dir(tmp_path):
    """The four CSV files and the state file, with a few rows each."""

    def put(name, schema, *rows):
        path = tmp_path / "data" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        lines = [",".join(r.get(n, "") for n in schema.names) for r in rows]
        path.write_text("\n".join([",".join(schema.names), *lines]) + "\n")

    files = readers.DEFAULT_FILES
    adult = {"AGEP": "30", "SEX": "1", "WAGP": "100", "WKHP": "40", "ADJINC": "1000000"}
    put(
        files["pusa"],
        schemas.PERSONS,
        {"SERIALNO": "p1", "ST": "01", "PINCP": "25000", "NOP": "1", "POVPIP": "501", **adult},
        {"SERIALNO": "p2", "ST": "01", "PINCP": "abc", **adult},
    )
    put(files["pusb"], schemas.PERSONS, {"SERIALNO": "p3", "ST": "72", "PINCP": "-50", **adult})
    put(
        files["accidents"],
        schemas.INCIDENTS,
        {
            "ID": "A-1",
            "State": "AL",
            "Severity": "2",
            "Start_Time": "2016-02-08 00:37:08.000000000",
            "Visibility(mi)": "10.0",
            "Weather_Condition": "Light Rain",
        },
        {"ID": "A-2", "State": "AL", "Severity": "4", "Start_Time": "bad"},
    )
    put(
        files["internet"],
        schemas.COVERAGE,
        {"StateAbbr": "AL", "ProviderName": "P", "MaxAdDown": "200", "Consumer": "1"},
    )
    state_file = tmp_path / "data" / readers.DEFAULT_STATE_FILE
    state_file.write_text("STATE|STUSAB|STATE_NAME|STATENS\n01|AL|Alabama|1\n72|PR|Puerto Rico|2\n")
    return str(tmp_path / "data")


def test_load_clean_store_and_read_back(spark, data_dir, tmp_path):
    raw = readers.load_tables(spark, data_dir)
    assert set(raw) == {"demographics", "pusa", "pusb", "accidents", "internet"}
    assert raw["demographics"].count() == 3
    readers.store_parquet(readers.clean_tables(raw), str(tmp_path / "parquet"))
    tables = readers.load_parquet(spark, str(tmp_path / "parquet"))
    assert rows_of(tables["demographics"].select("SERIALNO", "ST", "PINCP", "NOP")) == [
        ("p1", "01", 25000.0, 1),
        ("p2", "01", None, None),
        ("p3", "72", -50.0, None),
    ]
    times = tables["accidents"].select("ID", F.date_format("Start_Time", "HH:mm:ss"))
    assert rows_of(times) == [("A-1", "00:37:08"), ("A-2", None)]


def test_the_whole_job(spark, data_dir, tmp_path, monkeypatch):
    from tallyfield import job
    from tallyfield.plans.suite import QUESTIONS

    monkeypatch.setattr(job, "get_session", lambda name: spark)
    job.main(["--data", data_dir, "--out", str(tmp_path / "out")])
    reports = {p.name for p in (tmp_path / "out" / "reports").iterdir()}
    assert reports == set(QUESTIONS)
    x2 = spark.read.csv(str(tmp_path / "out/reports/X2"), header=True).collect()
    assert [tuple(r) for r in x2] == [("AL", "3.0", "2", "3.0002")]
    sizes = spark.read.csv(str(tmp_path / "out/statistics/sizes"), header=True).collect()
    assert ("demographics", "3", "287") in [tuple(r) for r in sizes]


    rejects = spark.read.csv(str(tmp_path / "out/statistics/rejects_pusa"), header=True).collect()
    assert ("(rows)", "2") in [tuple(r) for r in rejects]
    previewed = spark.read.csv(str(tmp_path / "out/statistics/accidents_preview"), header=True)
    assert len(previewed.columns) == 10 and previewed.count() == 2


def test_rejected_records(spark, tmp_path):
    """Bad cells by column, quotes, a long and a short line; an empty cell is no reject."""
    path = tmp_path / "rows.csv"
    path.write_text('a,b(mi),c\n1,2.5,"x ""y"", z"\nq,2.5,x\n,,\n3,1e400x,\n4,5,6,7\n8\n9,z,"a,b"\n')
    schema = "a int, `b(mi)` double, c string"
    rows = rejects.read_checked_csv(spark, str(path), T.StructType.fromDDL(schema))
    assert rows_of(rows.select("a", "c")) == sorted(
        [(1, 'x "y", z'), (None, "x"), (None, None), (3, None), (4, "6"), (8, None), (9, "a,b")], key=repr
    )
    assert rows.select(F.max("a")).first()[0] == 9  # one column alone
    assert dict(map(tuple, rejects.reject_counts(rows).collect())) == {
        "a": 1, "b(mi)": 2, "c": 0, "(rows)": 7, "(rejected rows)": 5, "(misshapen rows)": 2,
    }
    assert rows_of(rejects.accepted(rows)) == [(1, 2.5, 'x "y", z'), (None, None, None)]


def test_previews(spark, data_dir):
    tables = readers.clean_tables(readers.load_tables(spark, data_dir))
    assert {name: len(df.columns) for name, df in suite.preview_all(tables).items()} == {"demographics": 10, "accidents": 10, "internet": 10}
    profiles = suite.preview_profiles(tables, columns=2)
    assert {name: df.count() for name, df in profiles.items()} == {"demographics": 2, "accidents": 2, "internet": 2}


def test_states_lie_with_the_data(spark, data_dir):
    assert rows_of(readers.load_states(spark, data_dir)) == [("01", "AL"), ("72", "PR")]


def test_missing_data_set_is_named(spark):
    from tallyfield.plans.suite import run_all

    with pytest.raises(ValueError, match="accidents"):
        run_all(spark, {}, questions=["A1"])


def parts(path):
    return sorted(p.name for p in path.iterdir() if p.name.startswith("part-"))


def test_report_files(spark, tmp_path):
    for rows in (40, 4000):
        write_report(spark.range(0, rows, 1, 4), str(tmp_path / f"csv{rows}"))
        write_report(spark.range(0, rows, 1, 4), str(tmp_path / f"pq{rows}"), fmt="parquet")
        assert len(parts(tmp_path / f"csv{rows}")) == len(parts(tmp_path / f"pq{rows}")) == 4
        assert spark.read.csv(str(tmp_path / f"csv{rows}"), header=True).count() == rows


def test_report_counts_what_it_writes(spark, tmp_path, frame):
    path = str(tmp_path / "report")
    df = frame([(1, None), (None, None), (3, "x")], "a int, `b c` string")
    assert write_report(df, path) == {"(rows)": 3, "a": 1, "b c": 2}
    assert write_report(df.limit(0), path, fmt="parquet") == {"(rows)": 0, "a": 0, "b c": 0}
    assert spark.read.parquet(path).count() == 0


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_report_with_a_column_without_type(spark, tmp_path, fmt):
    path = str(tmp_path / "report")
    assert write_report(spark.range(3).withColumn("no type", F.lit(None)), path, fmt=fmt) == {"(rows)": 3, "id": 0, "no type": 3}
    assert spark.read.format(fmt).option("header", True).load(path).where("`no type` is null").count() == 3


def test_a_failed_report_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(spark.range(5), path)
    with pytest.raises(Exception, match="broken"):
        write_report(spark.range(5).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert spark.read.csv(path, header=True).count() == 5


def test_a_repeated_state_code_raises(spark, frame):
    states = frame([("01", "AL"), ("02", "AK"), (None, "x"), (None, "y")], "ST string, StateAbbr string")
    assert rows_of(checked_dimension(states, "ST", ["StateAbbr"])) == [("01", "AL"), ("02", "AK")]
    with pytest.raises(Exception, match="more than once in a dimension: 01"):
        checked_dimension(states.union(states.limit(1)), "ST", ["StateAbbr"]).collect()
