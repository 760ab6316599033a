"""Command line: ``python -m tessera {bronze,silver,profile} ...``.

Each command runs one job on the session ``spark-submit`` (or the local
default) provides and prints the path it wrote.
"""

from __future__ import annotations

import argparse

from tessera.session import build_session, shuffles_sized_for


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tessera")
    sub = parser.add_subparsers(dest="command", required=True)

    p = sub.add_parser("bronze", help="delimited snapshot -> typed Parquet snapshot")
    p.add_argument("source_path")
    p.add_argument("--dest-dir", default="data/bronze")
    p.add_argument("--sep", default="\t")
    p.add_argument("--single-line", action="store_true", help="no line breaks inside quoted fields: plain text is split")
    p.add_argument("--gcs", action="store_true", help="destination is a gs:// URI")

    p = sub.add_parser("silver", help="bronze snapshot -> curated snapshot")
    p.add_argument("bronze_path")
    p.add_argument("--dest-dir", default="data/silver")
    p.add_argument("--gcs", action="store_true", help="destination is a gs:// URI")

    p = sub.add_parser("profile", help="column profile of a source, as a JSON report")
    p.add_argument("source_path")
    p.add_argument("--format", choices=("tsv", "parquet"), default="tsv")
    p.add_argument("--out", default="data/bronze/profile_report.json")
    p.add_argument("--sample-rows", type=int, default=None)
    p.add_argument("--layout", choices=("file", "array", "lines"), default="file")
    p.add_argument("--columns", default=None, help="comma-separated subset of columns to profile")
    p.add_argument("--single-line", action="store_true", help="no line breaks inside quoted fields: plain text is split")
    p.add_argument("--approx", action="store_true", help="approximate distinct counts (HyperLogLog++)")

    args = parser.parse_args(argv)
    spark = build_session(app_name=f"tessera-{args.command}")
    source = args.bronze_path if args.command == "silver" else args.source_path
    # gzip text decompresses to roughly ten times its size
    expansion = 10.0 if str(source).endswith(".gz") else 1.0
    with shuffles_sized_for(spark, source, expansion):
        print(_run(spark, args))


def _run(spark, args) -> str:
    if args.command == "bronze":
        from tessera.plans.bronze import bronze_layer

        return bronze_layer(
            spark, args.source_path, args.dest_dir, gcs=args.gcs, sep=args.sep, multiline=not args.single_line
        )
    if args.command == "silver":
        from tessera.plans.silver import silver_layer

        return silver_layer(spark, args.bronze_path, args.dest_dir, gcs=args.gcs)
    from tessera.plans.profile_job import profile_job

    return profile_job(
        spark,
        args.source_path,
        args.out,
        fmt=args.format,
        columns=[c for c in args.columns.split(",") if c] if args.columns else None,
        sample_rows=args.sample_rows,
        approx=args.approx,
        layout=args.layout,
        multiline=not args.single_line,
    )


if __name__ == "__main__":
    main()
