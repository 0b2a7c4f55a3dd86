"""Command line: `run` a pipeline from a YAML file, run a single `stage`, or list the `stages`."""

from __future__ import annotations

import argparse
import sys
from typing import Any

from bindery import pipeline


def pairs(items: list[str]) -> dict[str, str]:
    bad = [x for x in items if "=" not in x]
    if bad:
        raise pipeline.ConfigError(f"name=value is expected: {', '.join(bad)}")
    return dict(x.split("=", 1) for x in items)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("bindery", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="all stages of a YAML file")
    run.add_argument("config")
    run.add_argument("--set", nargs="*", default=[], metavar="NAME=VALUE", help="values of ${NAME} in the file")
    one = sub.add_parser("stage", help="one stage")
    one.add_argument("name")
    one.add_argument("--input", nargs="*", default=[], metavar="FORMAT=PATH")
    one.add_argument("--set", nargs="*", default=[], metavar="SETTING=VALUE")
    for q in (run, one):
        q.add_argument("--out", required=True, help="folder that receives one table for each format that the stages give")
        q.add_argument("--check", action="store_true", help="check the settings and stop")
    sub.add_parser("stages", help="names, formats and settings of all stages")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "stages":
        for s in pipeline.STAGES.values():
            print(f"{s.name}: {', '.join(s.needs)} -> {', '.join(s.gives)}; settings {', '.join(s.settings)}")
        return 0
    try:
        if args.command == "run":
            config, at = pipeline.load(args.config, pairs(args.set)), args.config
        else:
            config, at = {"inputs": pairs(args.input), "stages": [{args.name: pairs(args.set)}]}, "."
        planned = pipeline.plan(config)
    except pipeline.ConfigError as e:
        print(e, file=sys.stderr)
        return 1
    if args.check:
        return 0
    from pyspark.sql import SparkSession

    from bindery.session import ship

    frames = pipeline.run(ship(SparkSession.builder.getOrCreate()), config, at)
    for fmt in dict.fromkeys(f for s, _ in planned.jobs for f in s.gives):
        _write(frames[fmt], f"{args.out}/{fmt}")
    return 0


def _write(table: Any, path: str) -> None:
    if isinstance(table, pipeline.models.MockModel):
        from pyspark.sql import SparkSession

        table.save(SparkSession.getActiveSession(), path)
    elif table.columns == ["rank", "value"]:
        table.select("value").write.mode("overwrite").text(path)
    else:
        table.write.mode("overwrite").parquet(path)


if __name__ == "__main__":
    sys.exit(main())
