"""Jobs from the command line, also under ``spark-submit``:

    python -m tripflow month --source <raw files> --year 2026 --month 1 [--base <uri>]
    python -m tripflow profile --base <uri> --year 2026 --month 1

The base defaults to ``TRIPFLOW_BASE``; a dataset is named by its month.
"""

from __future__ import annotations

import argparse

from tripflow.plans.month import run_month
from tripflow.plans.profile_job import profile
from tripflow.session import get_session
from tripflow.sources.io import read_layer
from tripflow.sources.layout import Layout


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tripflow")
    parser.add_argument("job", choices=("month", "profile"))
    parser.add_argument("--source", help="raw files to land (month)")
    parser.add_argument("--base", help="folder of the layers; default: TRIPFLOW_BASE")
    parser.add_argument("--year", type=int, required=True)
    parser.add_argument("--month", type=int, required=True)
    parser.add_argument("--replace", action="store_true", help="land again what is landed")
    args = parser.parse_args(argv)
    spark = get_session()
    layout = Layout.from_env(args.base, f"{args.year:04d}_{args.month:02d}")
    if args.job == "month":
        if not args.source:
            parser.error("month needs --source")
        mode = "replace" if args.replace else "skip"
        run = run_month(spark, args.source, layout, if_exists=mode, year=args.year, month=args.month)
        run.landed.show(truncate=False)
        run.reports["funnel"].show(truncate=False)
        run.reports["layers"].show(truncate=False)
    else:
        for name, figure in profile(read_layer(spark, layout.bronze), year=args.year, month=args.month).items():
            print(name)
            figure.show(50, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
