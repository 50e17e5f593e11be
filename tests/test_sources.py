"""Readers and writers: suffix resolution, CSV NULL tokens, coercion, schema checks."""

import gzip
import os

import pytest

from staylens.sources import sinks, tables

HEADER = "subject_id,hadm_id,admittime,dischtime,admission_type,admission_location,discharge_location,insurance,language,marital_status,race,hospital_expire_flag\n"
ROWS = [
    "1,10,2180-05-06 22:23:00,2180-05-08 10:00:00,EMERGENCY,ER,HOME,Medicare,ENGLISH,SINGLE,A,0\n",
    "2,11,bad,2180-05-08 10:00:00,NA,N/A,None,null,,NULL,B,1\n",
    "3,12,2180-05-07,2180-05-09 00:00:00,URGENT,ER,HOME,Medicaid,ENGLISH,MARRIED,C,0\n",
]


def write_csv(path, rows=ROWS, header=HEADER, gz=False):
    data = header + "".join(rows)
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(data)
    else:
        with open(path, "w") as f:
            f.write(data)


def test_csv_tokens_and_dates(spark, tmp_dir):
    write_csv(os.path.join(tmp_dir, "admissions.csv"))
    df = tables.load_admissions(spark, tmp_dir)
    rows = {r["hadm_id"]: r for r in df.collect()}
    assert rows[11]["admittime"] is None  # bad text -> NULL
    assert all(rows[11][c] is None for c in ("admission_type", "admission_location", "discharge_location", "insurance", "language", "marital_status"))
    assert rows[12]["admittime"].day == 7  # date-only value kept
    assert dict(df.dtypes)["hadm_id"] == "bigint" and dict(df.dtypes)["admittime"] == "timestamp_ntz"


def test_resolution_order(spark, tmp_dir):
    write_csv(os.path.join(tmp_dir, "admissions.csv.gz"), ROWS[:1], gz=True)
    write_csv(os.path.join(tmp_dir, "admissions.csv"), ROWS)
    spark.createDataFrame([(1,)], "x int").write.parquet(os.path.join(tmp_dir, "admissions.parquet"))
    assert tables.resolve_table_path(spark, tmp_dir, "admissions").endswith("admissions.csv.gz")
    assert tables.load_admissions(spark, tmp_dir).count() == 1


def test_missing_inputs(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        tables.resolve_table_path(spark, tmp_dir, "patients")
    with pytest.raises(FileNotFoundError):
        tables.resolve_table_path(spark, os.path.join(tmp_dir, "nope"), "patients")
    write_csv(os.path.join(tmp_dir, "admissions.csv"), [r.rsplit(",", 1)[0] + "\n" for r in ROWS], header=HEADER.rsplit(",", 1)[0] + "\n")
    with pytest.raises(ValueError, match="hospital_expire_flag"):
        tables.load_admissions(spark, tmp_dir)


def test_unsupported_suffix(spark, tmp_dir):
    with pytest.raises(ValueError):
        tables.read_table(spark, os.path.join(tmp_dir, "x.json"))
    with pytest.raises(ValueError):
        sinks.save_dataframe(spark.range(1), os.path.join(tmp_dir, "x.txt"))


def test_sink_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", 2.5)], "id long, s string, v double")
    paths = sinks.save_report_tables({"t1": df, "t2": df}, tmp_dir, "parquet")
    assert spark.read.parquet(paths["t1"]).collect() == df.collect()
    p = sinks.save_dataframe(df, os.path.join(tmp_dir, "out.csv"))
    back = spark.read.option("header", True).csv(p).collect()[0]
    assert back["s"] == "a" and back["v"] == "2.5"


def test_patients_and_core_join(spark, tmp_dir):
    write_csv(os.path.join(tmp_dir, "admissions.csv"))
    with open(os.path.join(tmp_dir, "patients.csv"), "w") as f:
        f.write("subject_id,gender,anchor_age,anchor_year\n1,F,60,2180\n1,M,61,2181\n2,M,NA,2180\n")
    core = tables.load_core_admissions_dataset(spark, tmp_dir, tmp_dir)
    assert core.count() == 3
    assert {r["hadm_id"]: r["anchor_age"] for r in core.collect()}[11] is None


def test_missing_bundle_is_none(spark, tmp_dir):
    from staylens.sources.artifacts import load_model_bundle

    assert load_model_bundle(spark, os.path.join(tmp_dir, "absent")) is None


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_cohort_round_trip(spark, tmp_dir, fmt):
    from staylens.plans.fixtures import cohort_sql

    cohort = cohort_sql(spark, "/root/testdata/sf0.001")
    path = sinks.save_dataframe(cohort, os.path.join(tmp_dir, f"cohort_base.{fmt}"))
    back = tables.load_cohort(spark, path)
    cols = ["hadm_id", "admittime", "dischtime", "los_days", "age_at_admit", "insurance"]
    norm = lambda rows: sorted((r[0], r[1], r[2], round(r[3], 9), r[4], r[5]) for r in rows)
    assert norm(back.select(*cols).collect()) == norm(cohort.select(*cols).collect())


def test_quoted_values(spark, tmp_dir):
    path = os.path.join(tmp_dir, "q.csv")
    with open(path, "w") as f:
        f.write('a,b,c\n1,"say ""hi"", ok",x\n\n2,"",y\n')
    rows = [tuple(r) for r in tables.read_table(spark, path).collect()]
    assert rows == [("1", 'say "hi", ok', "x"), ("2", None, "y")]


def test_line_break_in_a_value(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m.csv")
    with open(path, "w") as f:
        f.write('a,b\n1,"two\nlines"\n2,z\n')
    with pytest.raises(Exception, match="multi_line=True"):
        tables.read_table(spark, path).collect()
    assert [tuple(r) for r in tables.read_table(spark, path, multi_line=True).collect()] == [("1", "two\nlines"), ("2", "z")]


def test_whole_numbers_with_a_fraction_point(spark):
    df = spark.createDataFrame([("65.0", "10023.0"), ("65.5", "x"), (" 7 ", "9007199254740993"), (None, "1e3")], "anchor_age string, subject_id string")
    got = [tuple(r) for r in tables.coerce_types(df, tables.PATIENTS_TYPES).collect()]
    assert got == [(65, 10023), (None, None), (7, 9007199254740993), (None, 1000)]
    report = {r["column"]: (r["n_values"], r["n_lost"]) for r in tables.coercion_report(df, tables.PATIENTS_TYPES).collect()}
    assert report == {"anchor_age": (3, 1), "subject_id": (4, 1)}


def test_csv_round_trip_keeps_text(spark, tmp_dir):
    rows = [('a "b", c', " padded ", 1), ("x,y", None, 2)]
    df = spark.createDataFrame(rows, "p string, q string, n int")
    for suffix in ("csv", "csv.gz"):
        path = sinks.save_dataframe(df, os.path.join(tmp_dir, f"t.{suffix}"))
        assert sorted((r.p, r.q, int(r.n)) for r in tables.read_table(spark, path).collect()) == sorted(rows)


def test_data_row_equal_to_the_header_stays(spark, tmp_dir):
    import os

    from staylens.sources.tables import read_table

    folder = f"{tmp_dir}/t.csv"
    os.makedirs(folder)
    for part in (1, 2):
        with open(f"{folder}/part-{part}.csv", "w") as f:
            f.write('a,b\na,b\n1,"x, y"\n\n  2,\n3\n')
    rows = sorted(map(tuple, read_table(spark, folder).collect()), key=str)
    assert rows == sorted([("a", "b"), ("1", "x, y"), ("  2", None), ("3", None)] * 2, key=str)


def test_too_many_fields_raise(spark, tmp_dir):
    from staylens.sources.tables import read_table

    with open(f"{tmp_dir}/t.csv", "w") as f:
        f.write("a,b\n1,x\n2,y,extra\n")
    with pytest.raises(Exception, match="more than 2 fields"):
        read_table(spark, f"{tmp_dir}/t.csv").collect()
