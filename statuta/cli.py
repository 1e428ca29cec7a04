"""Command line: validate files, scan for unsafe characters, look up laws and articles.

    python -m statuta.cli validate FILE...                 0: all pass, 1: some fail, 2: nothing given
    python -m statuta.cli check-encoding --path DIR        0: cp932-safe, 1: FAIL
    python -m statuta.cli get-law ROOT ABBREV
    python -m statuta.cli get-article ROOT ABBREV NUMBER   1: no such article
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path
from urllib.parse import unquote, urlsplit

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from statuta.operators import integrity, safety
from statuta.ship import ship
from statuta.sources import articles


def _session() -> SparkSession:
    return ship(SparkSession.builder.appName("statuta").getOrCreate())


def format_result(path: str, violations: list[str], root: str | None = None) -> str:
    """One line for a file, its path relative to root where it lies below that."""
    path = urlsplit(path).path if path.startswith("file:") else path
    if root and Path(path).is_relative_to(root):
        path = str(Path(path).relative_to(root))
    return ("FAIL" if violations else "PASS") + f" {path}" + (f": {', '.join(violations)}" if violations else "")


def validate(paths: list[str], root: str | None = None) -> int:
    """Prints a line per file in the order of paths, goes on after a failure, and sums up on standard error."""
    if not paths:
        print("usage: validate FILE...", file=sys.stderr)
        return 2
    found = integrity.validate(articles.parse(articles.scan(_session(), *paths)))
    n = failed = 0
    for row in found.orderBy("path").toLocalIterator():
        print(format_result(unquote(row["path"]), row["violations"], root or str(Path.cwd())))
        n, failed = n + 1, failed + (not row["ok"])
    if failed:
        print(f"violations in {failed} of {n} files", file=sys.stderr)
    return 2 if not n else 1 if failed else 0


def check_encoding(path: str) -> int:
    checked = safety.check_encoding(articles.scan(_session(), path), "value")
    code, message = safety.verdict(checked)
    print(message, file=sys.stderr if code else sys.stdout)
    return code


def show(root: str, abbrev: str, number: str | None = None) -> int:
    rows = articles.read_articles(_session(), root, law_abbrev=abbrev)
    if number is not None:
        rows = rows.where(F.col("article_number") == number)
    n = 0
    for n, row in enumerate(rows.select("article_id", "law_id", "body").toLocalIterator(), 1):  # noqa: B007
        print(row["article_id"], row["law_id"], *([row["body"]] if number is not None else []))
    return 0 if n else 1


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="statuta")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("validate").add_argument("paths", nargs="*")
    commands.add_parser("check-encoding").add_argument("--path", required=True)
    for name, fields in (("get-law", ("root", "abbrev")), ("get-article", ("root", "abbrev", "number"))):
        sub = commands.add_parser(name)
        for field in fields:
            sub.add_argument(field)
    args = parser.parse_args(argv)
    if args.command == "validate":
        return validate(args.paths)
    if args.command == "check-encoding":
        return check_encoding(args.path)
    return show(args.root, args.abbrev, getattr(args, "number", None))


if __name__ == "__main__":
    sys.exit(main())
