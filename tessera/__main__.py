"""Command line: python -m tessera convert | validate | prepare."""

from __future__ import annotations

import argparse
import json
import sys

from tessera.functions.labelling import Options
from tessera.operators.checks import DatasetError


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tessera", formatter_class=argparse.ArgumentDefaultsHelpFormatter)
    kinds = top.add_subparsers(dest="command", required=True)
    for name, what in (("convert", "masks and images to a new dataset"), ("prepare", "the same unless it is there, then validate it")):
        p = kinds.add_parser(name, help=what, formatter_class=argparse.ArgumentDefaultsHelpFormatter)
        p.add_argument("--source", default=".", help="the source's root, its parent, or the category's folder")
        p.add_argument("--category", required=True)
        p.add_argument("--output", required=True, help="a folder that driver and executors share")
        p.add_argument("--split", type=float, nargs=3, default=[0.70, 0.15, 0.15], metavar=("TRAIN", "VAL", "TEST"))
        p.add_argument("--seed", type=int, default=42)
        p.add_argument("--shuffle", choices=["hash", "compat"], default="hash")
        p.add_argument("--box-mode", choices=["components", "union"], default="components")
        p.add_argument("--connectivity", type=int, choices=[4, 8], default=8)
        p.add_argument("--min-area", type=int, default=1)
        p.add_argument("--padding", type=int, default=0)
        p.add_argument("--previews", type=int, default=24)
        if name == "convert":
            p.add_argument("--check-only", action="store_true", help="validate and plan, write nothing")
    p = kinds.add_parser("validate", help="re-validate a dataset")
    p.add_argument("root")
    p.add_argument("--without-test", action="store_true")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from pyspark.sql import SparkSession

    from tessera.plans import convert as plans

    spark = SparkSession.builder.appName("tessera").getOrCreate()
    try:
        if args.command == "validate":
            out = plans.validate(spark, args.root, not args.without_test)
        else:
            options = {"options": Options(args.box_mode, args.min_area, args.padding, args.connectivity), "ratios": args.split, "seed": args.seed, "mode": args.shuffle, "previews": args.previews}
            if args.command == "prepare":
                out = plans.prepare(spark, args.source, args.output, args.category, **options)
            else:
                out = plans.convert(spark, args.source, args.output, args.category, check_only=args.check_only, **options)
    except (DatasetError, ValueError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    print(json.dumps(out, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
