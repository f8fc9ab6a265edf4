"""The whole job: files and code tables in, report tables out.

The same flow as the reference script, as one call: build the regional and
national facts, compute the national and state reports, and replace their
targets; optionally the area reports too. Each report is its own overwrite, so a
failed target never leaves the others half written.

    python -m jobtrend.plans.job --sm data/sm.data.1.AllData \\
        --ce data/ce.data.07 data/ce.data.08 --codes-format parquet --codes-dir codes/ \\
        --out reports/ [--areas] [--format parquet|csv|jdbc]
"""

from __future__ import annotations

import argparse
import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from jobtrend.params import ReportParams
from jobtrend.plans.facts import national_fact_from_files, regional_fact_from_files
from jobtrend.plans.frames import area_sums_of, national_frames, regional_cube, regional_frames, state_sums_of
from jobtrend.plans.reports import area_report_of, national_report, state_report_of
from jobtrend.session import checkpointed
from jobtrend.sources.sinks import write_report

REGIONAL_CODES = ("sm_series", "sm_industry", "sm_supersector", "sm_state", "sm_area")
NATIONAL_CODES = ("ce_series", "ce_industry", "ce_supersector")


class JobFailed(RuntimeError):
    """Some targets could not be written; ``written`` and ``failed`` tell which."""

    def __init__(self, written: dict[str, str], failed: dict[str, Exception]):
        super().__init__("; ".join(f"{name}: {error}" for name, error in failed.items()))
        self.written, self.failed = written, failed


def run_job(
    spark: SparkSession,
    sm_path: str,
    ce_paths: Sequence[str],
    out: str,
    code_format: str = "parquet",
    code_paths: dict[str, str] | None = None,
    code_options: dict[str, str] | None = None,
    out_format: str = "parquet",
    out_options: dict[str, str] | None = None,
    params: ReportParams = ReportParams(),
    areas: bool = False,
    frames: bool = False,
) -> dict[str, str]:
    """Compute and write the reports; returns {target name: location}.

    ``out`` is a folder for file formats, or ignored for JDBC (targets are table
    names, connection in ``out_options``). ``code_options`` go to the reader of the code
    tables only, ``out_options`` to the writers only. ``frames`` writes the intermediate
    frames too.

    Targets are built and written one after the other. One that fails is reported at the
    end (``JobFailed``), after all others have been written. All regional reports come
    from one aggregate of the regional fact, kept in the shared folder.
    """
    national = national_fact_from_files(spark, ce_paths, code_format, code_paths, code_options)
    regional = regional_fact_from_files(spark, sm_path, code_format, code_paths, code_options, params)
    kept: dict[str, DataFrame] = {}

    def cube() -> DataFrame:
        if "cube" not in kept:
            kept["cube"] = checkpointed(regional_cube(regional, params))
        return kept["cube"]

    targets = {
        "national_rankings_t": lambda: national_report(national, params),
        "state_rankings_t": lambda: state_report_of(state_sums_of(cube()), params),
    }
    if areas:
        for name, cohort in (("msa_rankings_t", "all"), ("msa_rankings_over", "over"), ("msa_rankings_under", "under")):
            targets[name] = lambda cohort=cohort: area_report_of(area_sums_of(cube(), params, cohort), params, cohort)
    if frames:
        more = national_frames(national, params) | regional_frames(regional, params)
        targets |= {name: lambda df=df: df for name, df in more.items()}
    written, failed = {}, {}
    for name, build in targets.items():
        target = name if out_format == "jdbc" else os.path.join(out, name)
        try:
            write_report(build(), target, fmt=out_format, options=out_options)
        except Exception as error:  # the other targets are independent of this one
            failed[name] = error
        else:
            written[name] = target
    if failed:
        raise JobFailed(written, failed)
    return written


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Employment growth reports on Spark")
    ap.add_argument("--sm", required=True, help="regional observation file")
    ap.add_argument("--ce", required=True, nargs="+", help="national observation files")
    ap.add_argument("--out", required=True, help="output folder (file formats)")
    ap.add_argument("--format", default="parquet", choices=("parquet", "csv", "jdbc"))
    ap.add_argument("--codes-format", default="parquet", choices=("parquet", "csv", "jdbc"))
    ap.add_argument("--codes-dir", default=None, help="folder holding one entry per code table")
    ap.add_argument("--codes-options", default=None, help="JSON file of reader options for the code tables")
    ap.add_argument("--out-options", default=None, help="JSON file of writer options for the targets")
    ap.add_argument("--ytd-months", type=int, default=ReportParams().ytd_months)
    ap.add_argument("--areas", action="store_true", help="also write the area reports")
    ap.add_argument("--frames", action="store_true", help="also write the intermediate frames")
    args = ap.parse_args(argv)

    def options(path: str | None) -> dict[str, str] | None:
        if path is None:
            return None
        with open(path) as fh:
            return json.load(fh)

    code_paths = None
    if args.codes_dir:
        code_paths = {n: os.path.join(args.codes_dir, n) for n in (*REGIONAL_CODES, *NATIONAL_CODES)}
    from jobtrend.session import build_session

    spark = build_session()
    written = run_job(
        spark, args.sm, args.ce, args.out, args.codes_format, code_paths, options(args.codes_options),
        args.format, options(args.out_options), ReportParams(ytd_months=args.ytd_months), args.areas, args.frames,
    )
    print(json.dumps(written))


if __name__ == "__main__":
    main()
