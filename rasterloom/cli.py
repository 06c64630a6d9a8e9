"""Command line: ``python -m rasterloom.cli VERB ...``.

    ids FOLDER OUT                    manifest of the rasters below a folder
    mm MANIFEST METADATA OUT          groups, bundles and the enriched manifest
    tp MANIFEST METADATA OUT [--size N]   tile plan of the bundles
    query NAME SF_DIR [OUT]           one registered query

Exit codes: 0, 1 after a failure, 3 for an unknown verb.
"""

from __future__ import annotations

import argparse
import sys

from rasterloom.plans import catalogue, pipelines
from rasterloom.session import get_session
from rasterloom.sources import inputs, sinks

VERBS = ("ids", "mm", "tp", "query")


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    if not argv or argv[0] not in VERBS:
        print(__doc__, file=sys.stderr)
        return 3
    parser = argparse.ArgumentParser(prog=f"rasterloom {argv[0]}")
    names = {"ids": ["folder", "out"], "mm": ["manifest", "metadata", "out"], "tp": ["manifest", "metadata", "out"], "query": ["name", "sf_dir"]}[argv[0]]
    for name in names:
        parser.add_argument(name)
    parser.add_argument("--size", type=int, default=512)
    parser.add_argument("--exempt", default="")
    if argv[0] == "query":
        parser.add_argument("out", nargs="?")
    args = parser.parse_args(argv[1:])
    if args.size <= 0 or args.size % 16:
        parser.error("--size must be a positive multiple of 16")
    spark = get_session("rasterloom")
    if argv[0] == "ids":
        exempt = tuple(e for e in args.exempt.split(",") if e)
        try:
            sinks.write_manifest(pipelines.manifest_of(inputs.discover(spark, args.folder, exempt=exempt)), args.out)
        except ValueError as nothing:
            print(nothing, file=sys.stderr)
            return 1
        return 0
    if argv[0] == "query":
        df = catalogue.queries()[args.name](spark, args.sf_dir)
        sinks.write(df, "parquet", args.out) if args.out else df.show(20, truncate=False)
        return 0
    grouping = pipelines.group_rasters(spark.read.parquet(args.manifest), spark.read.parquet(args.metadata))
    if argv[0] == "tp":
        sinks.write(pipelines.plan_tiles(grouping, args.size, args.size), "parquet", args.out)
        return 0
    for name in ("members", "intersections", "summary", "bundles", "manifest"):
        sinks.write(getattr(grouping, name), "parquet", f"{args.out}/{name}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
