"""Sources and sinks: TSV observations (SRC1, SRC2), code tables (SRC3), star
joins from files (RPT1, RPT2), report writes (SNK1-SNK3)."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from jobtrend.plans.facts import national_fact_from_files, regional_fact_from_files
from jobtrend.sources.codes import read_code_table
from jobtrend.sources.sinks import write_csv, write_report
from jobtrend.sources.tsv import NATIONAL_STRIPPED, read_observations

HEADER = "series_id\tyear\tperiod\tvalue\tfootnote_codes\n"


def write_text(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_regional_file_scan_strips_and_coerces(spark, scratch):
    p = os.path.join(scratch, "sm.data.txt")
    write_text(p, HEADER
               + "SMU01000000000000001     \t 2015\tM01\t   12.5\t \n"
               + "SMU01000000000000001     \t2015\tM02\t-\t\n"
               + "SMU01000000000000001\t2015\tM03\t\t1\n")
    rows = read_observations(spark, p).collect()
    assert [(r.series_id, r.year, r.period, r.value) for r in rows] == [
        ("SMU01000000000000001", "2015", "M01", "12.5"),
        ("SMU01000000000000001", "2015", "M02", "-"),
        ("SMU01000000000000001", "2015", "M03", None),
    ]


def test_national_files_append_as_a_bag(spark, scratch):
    a = os.path.join(scratch, "ce", "ce.data.07.txt")
    b = os.path.join(scratch, "ce", "ce.data.08.txt")
    line = "CEU0000000001  \t2015\tM01\t  100\t\n"
    write_text(a, HEADER + line)
    write_text(b, HEADER + line + "CEU0000000002\t2015\tM01\t 7\t\n")
    rows = read_observations(spark, [a, b], NATIONAL_STRIPPED).collect()
    assert sorted((r.series_id, r.value) for r in rows) == [
        ("CEU0000000001", "  100"), ("CEU0000000001", "  100"), ("CEU0000000002", " 7"),
    ]


def _write_regional_codes(spark, scratch):
    tables = {
        "sm_series": spark.createDataFrame(
            [("SMU01", "1", "0", "0", "0", "1", "U"), ("SMS01", "1", "0", "0", "0", "1", "S"),
             ("SMU02", "1", "10180", "10", "5", "1", "U")],
            "series_id string, state_code string, area_code string, industry_code string, "
            "supersector_code string, data_type_code string, seasonal string"),
        "sm_industry": spark.createDataFrame([(0, "Total Nonfarm"), (10, "Mining")], "industry_code int, industry_name string"),
        "sm_supersector": spark.createDataFrame([(0, "Total Nonfarm\r"), (5, "Mining\r")], "supersector_code int, supersector_name string"),
        "sm_state": spark.createDataFrame([("1", "Alabama\r")], "state_code string, state_name string"),
        "sm_area": spark.createDataFrame([("00000\n", "Statewide"), ("10180", "Abilene, TX Metropolitan Statistical Area")],
                                         "area_code string, area_name string"),
    }
    paths = {}
    for name, df in tables.items():
        paths[name] = os.path.join(scratch, "codes", name)
        df.write.mode("overwrite").parquet(paths[name])
    return paths


def test_regional_fact_from_files(spark, scratch):
    obs = os.path.join(scratch, "sm.data.1.AllData.txt")
    write_text(obs, HEADER
               + "SMU01   \t2015\tM01\t 10\t\n"
               + "SMS01   \t2015\tM01\t 11\t\n"
               + "SMU02   \t2015\tM01\t-\t\n"
               + "SMU99   \t2015\tM01\t 3\t\n")  # no such series: dropped by the inner join
    paths = _write_regional_codes(spark, scratch)
    got = sorted(tuple(r) for r in regional_fact_from_files(spark, obs, "parquet", paths).collect())
    assert got == [
        ("Abilene, TX ", "Alabama", "Mining", "Mining", "M01", "2015", None, "01", "U"),
        ("Statewide", "Alabama", "Total Nonfarm", "Total Nonfarm", "M01", "2015", 10.0, "01", "U"),
        ("Statewide", "Alabama", "Total Nonfarm", "Total Nonfarm", "M01", "2015", 11.0, "01", "S"),
    ]


def test_national_fact_from_files(spark, scratch):
    f1 = os.path.join(scratch, "ce1.txt")
    f2 = os.path.join(scratch, "ce2.txt")
    write_text(f1, HEADER + "CEU1\t2015\tM01\t 5\t\n")
    write_text(f2, HEADER + "CEU1\t2015\tM01\t 5\t\n" + "CES1\t2015\tM01\t6\t\n")
    codes = {
        "ce_series": spark.createDataFrame([(" CEU1 ", 10, 5, "01", "U"), ("CES1", 10, 5, "01", "S")],
                                           "series_id string, industry_code int, supersector_code int, "
                                           "data_type_code string, seasonal string"),
        "ce_industry": spark.createDataFrame([("00000010", "Mining")], "industry_code string, industry_name string"),
        "ce_supersector": spark.createDataFrame([("5", "Mining")], "supersector_code string, supersector_name string"),
    }
    paths = {}
    for name, df in codes.items():
        paths[name] = os.path.join(scratch, "ce", name)
        df.write.mode("overwrite").parquet(paths[name])
    got = sorted(tuple(r) for r in national_fact_from_files(spark, [f1, f2], "parquet", paths).collect())
    assert got == [
        ("Mining", "Mining", "M01", "2015", 5.0, "01", "U"),
        ("Mining", "Mining", "M01", "2015", 5.0, "01", "U"),
        ("Mining", "Mining", "M01", "2015", 6.0, "01", "S"),
    ]


def test_code_table_csv_reader(spark, scratch):
    p = os.path.join(scratch, "sm_state.txt")
    write_text(p, "state_code\tstate_name\n01\tAlabama\n")
    rows = read_code_table(spark, "sm_state", "csv", p).collect()
    assert [tuple(r) for r in rows] == [("01", "Alabama")]


def test_write_report_parquet_with_index_and_csv(spark, scratch):
    df = spark.createDataFrame(
        [("b", "2015", 2.0, None), ("a", "2015", 1.0, 3.0), ("a", "2014", None, 1.0)],
        "state_name string, year string, value double, rank double")
    out = os.path.join(scratch, "state_rankings_t")
    write_report(df, out, with_index=["state_name", "year"])
    got = sorted((r["index"], r.state_name, r.year) for r in spark.read.parquet(out).collect())
    assert got == [(0, "a", "2014"), (1, "a", "2015"), (2, "b", "2015")]
    # overwrite replaces the table
    write_report(df.where(F.col("state_name") == "a"), out)
    assert spark.read.parquet(out).count() == 2
    csv_out = os.path.join(scratch, "state_rankings_csv")
    write_csv(df, csv_out)
    text = "".join(open(os.path.join(csv_out, f)).read() for f in sorted(os.listdir(csv_out)) if f.endswith(".csv"))
    assert "state_name,year,value,rank" in text
    assert "b,2015,2.0," in text  # NULL rank written as an empty field


def test_write_report_sorted_output(spark, scratch):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "k string, v int").repartition(3)
    out = os.path.join(scratch, "sorted_csv")
    write_report(df, out, fmt="csv", sort_by=["k"])
    parts = sorted(f for f in os.listdir(out) if f.endswith(".csv"))
    keys = []
    for f in parts:
        keys += [line.split(",")[0] for line in open(os.path.join(out, f)).read().splitlines()[1:]]
    assert keys == ["a", "b", "c"]


def test_reporting_month(spark):
    from jobtrend.params import ReportParams
    from jobtrend.sources.codes import reporting_month

    df = spark.createDataFrame([("2014", "12"), ("2015", "03"), ("2015", "05")], "year string, Month string")
    assert ReportParams(ytd_months=reporting_month(df)).ytd_months == 5


def test_run_job_end_to_end(spark, scratch):
    from jobtrend.plans.job import run_job

    sm = os.path.join(scratch, "sm.data.1.AllData.txt")
    lines = []
    for y in (2014, 2015):
        for m in range(1, 13):
            lines.append(f"SMU01   \t{y}\tM{m:02d}\t {100 + m + (y - 2014) * 12}\t\n")
            lines.append(f"SMS01   \t{y}\tM{m:02d}\t {90 + m}\t\n")
    lines.append("SMU01   \t2015\tM13\t 999\t\n")  # annual average row: left out
    write_text(sm, HEADER + "".join(lines))
    paths = _write_regional_codes(spark, scratch)
    ce = os.path.join(scratch, "ce.data.07.txt")
    write_text(ce, HEADER + "".join(f"CEU1\t2015\tM{m:02d}\t{m}\t\n" for m in range(1, 13))
               + "".join(f"CES1\t2015\tM{m:02d}\t{m}\t\n" for m in range(1, 13)))
    codes = {
        "ce_series": spark.createDataFrame([("CEU1", 10, 5, "01", "U"), ("CES1", 10, 5, "01", "S")],
                                           "series_id string, industry_code int, supersector_code int, "
                                           "data_type_code string, seasonal string"),
        "ce_industry": spark.createDataFrame([("10", "Mining")], "industry_code string, industry_name string"),
        "ce_supersector": spark.createDataFrame([("5", "Mining")], "supersector_code string, supersector_name string"),
    }
    for name, df in codes.items():
        paths[name] = os.path.join(scratch, "codes", name)
        df.write.mode("overwrite").parquet(paths[name])
    out = os.path.join(scratch, "reports")
    written = run_job(spark, sm, [ce], out, "parquet", paths, areas=True)
    assert set(written) == {"national_rankings_t", "state_rankings_t", "msa_rankings_t",
                            "msa_rankings_over", "msa_rankings_under"}
    state = spark.read.parquet(written["state_rankings_t"]).orderBy("year", "Month").collect()
    assert len(state) == 24
    last = state[-1]
    # 12-month change of the unadjusted value: December 2015 (124) over December 2014 (112)
    assert last.pct_change == round((124.0 / 112.0 - 1) * 100, 2)
    assert last.abs_growth == 12.0
    assert last["rank"] == 1.0
    national = spark.read.parquet(written["national_rankings_t"]).collect()
    assert len(national) == 12 and {r.state_name for r in national} == {"United States"}


def test_run_job_writes_the_other_targets_when_one_fails(spark, scratch, monkeypatch):
    """D12: a failing area report leaves the others written, and the regional fact is read once."""
    import pytest

    from jobtrend.plans import job

    sm = os.path.join(scratch, "sm.txt")
    write_text(sm, HEADER + "".join(f"SMU01   \t2015\tM{m:02d}\t {m}\t\n" for m in range(1, 13)))
    paths = _write_regional_codes(spark, scratch)
    ce = os.path.join(scratch, "ce.txt")
    write_text(ce, HEADER + "CEU1\t2015\tM01\t1\t\n")
    for name, cols in (("ce_series", "series_id string, industry_code string, supersector_code string, data_type_code string, seasonal string"),
                       ("ce_industry", "industry_code string, industry_name string"),
                       ("ce_supersector", "supersector_code string, supersector_name string")):
        paths[name] = os.path.join(scratch, "codes", name)
        spark.createDataFrame([], cols).write.mode("overwrite").parquet(paths[name])
    cubes = []
    whole, areas = job.regional_cube, job.area_sums_of
    monkeypatch.setattr(job, "regional_cube", lambda *a: cubes.append(1) or whole(*a))

    def broken(cube, params, cohort):
        if cohort == "over":
            raise RuntimeError("no over cohort today")
        return areas(cube, params, cohort)

    monkeypatch.setattr(job, "area_sums_of", broken)
    with pytest.raises(job.JobFailed) as failed:
        job.run_job(spark, sm, [ce], os.path.join(scratch, "out"), "parquet", paths, areas=True, frames=True)
    assert set(failed.value.failed) == {"msa_rankings_over"}
    assert set(failed.value.written) == {
        "national_rankings_t", "state_rankings_t", "msa_rankings_t", "msa_rankings_under", "national_rankings_mom",
        "sm_table_final_v3", "sm_table_final_v2", "msa_rankings_over_mom", "msa_rankings_under_mom"}
    for path in failed.value.written.values():
        spark.read.parquet(path).count()
    assert len(cubes) == 1


def test_checkpoint_folder_required_on_a_cluster():
    """Without spark.checkpoint.dir a cluster session is refused a local folder."""
    import pytest

    from jobtrend.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

        def setCheckpointDir(self, path):
            raise AssertionError("must not set a local folder on a cluster")

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_write_that_dies_leaves_the_old_target_whole(spark, scratch, fmt):
    out = os.path.join(scratch, "report")
    write_report(spark.range(5), out, fmt=fmt)
    before = sorted(os.listdir(out))
    dies = spark.range(1000).repartition(4).select(F.when(F.col("id") == 777, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_report(dies, out, fmt=fmt)
    assert sorted(os.listdir(out)) == before and os.listdir(scratch) == ["report"]


def test_a_report_may_read_what_it_replaces(spark, scratch):
    out = os.path.join(scratch, "report/")
    write_report(spark.range(5), out)
    write_report(spark.read.parquet(out).where("id > 2"), out)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [3, 4]
    assert os.listdir(scratch) == ["report"]


def test_a_rename_that_fails_puts_the_old_target_back(spark, scratch, monkeypatch):
    from jobtrend.sources import sinks

    out = os.path.join(scratch, "report")
    write_report(spark.range(5), out)
    rename = sinks._Files.rename

    def fails_for_new(self, a, b):
        if ".new-" in a:
            raise OSError("no place")
        rename(self, a, b)

    monkeypatch.setattr(sinks._Files, "rename", fails_for_new)
    with pytest.raises(OSError):
        write_report(spark.range(9), out)
    assert spark.read.parquet(out).count() == 5 and os.listdir(scratch) == ["report"]


def test_each_code_table_has_its_own_reader_options(monkeypatch):
    from jobtrend.sources import codes

    asked = {}
    monkeypatch.setattr(codes, "read_code_table", lambda spark, name, fmt, path, options: asked.setdefault(name, (fmt, path, options)))
    own = codes.parallel_reads("series_number", 1, 10**9, 64)
    codes.read_code_tables(None, ["sm_state", "sm_series"], "jdbc", options={"url": "u", "fetchsize": "10"}, table_options={"sm_series": {**own, "fetchsize": "9000"}})
    assert asked["sm_state"] == ("jdbc", None, {"url": "u", "fetchsize": "10"})
    assert asked["sm_series"] == (
        "jdbc", None, {"url": "u", "fetchsize": "9000", "partitionColumn": "series_number", "lowerBound": "1", "upperBound": "1000000000", "numPartitions": "64"},
    )
    with pytest.raises(ValueError):
        codes.read_code_tables(None, ["sm_state"], table_options={"sm_series": own})
    with pytest.raises(ValueError):
        codes.parallel_reads("x", 0, 1, 0)


def test_scratch_folders_go_when_their_block_ends(spark):
    from jobtrend.session import scratch as removed_after
    from jobtrend.session import shared_folder

    kept = shared_folder(spark, "kept")
    spark.range(1).write.parquet(kept)
    with removed_after():
        gone = shared_folder(spark, "gone")
        spark.range(1).write.parquet(gone)
        assert spark.read.parquet(gone).count() == 1
    assert not os.path.exists(gone.removeprefix("file:")) and spark.read.parquet(kept).count() == 1


def test_shared_folders_of_any_store_go_after_the_session_stopped(scratch):
    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config(map={{
    "spark.ui.enabled": "false", "spark.checkpoint.dir": "viewfs://store/in", "spark.hadoop.fs.viewfs.mounttable.store.link./in": "file://{scratch}"}}).getOrCreate()
from jobtrend.session import shared_folder
path = shared_folder(spark, "table")
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3
spark.stop()
"""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=120)
    assert not [x for x in os.listdir(scratch) if x.startswith("table-")]
