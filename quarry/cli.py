"""``python -m quarry.cli compile|TOOL ...``: the index tools, answers as JSON lines."""

from __future__ import annotations

import argparse
import json

from quarry.plans.index import Index, compile_index
from quarry.session import session

TOOLS = {
    "search-wiki": ("search_wiki", ["query"]),
    "search-claims": ("search_claims", ["query"]),
    "read-page": ("read_page", ["path"]),
    "get-entity": ("get_entity", ["entity"]),
    "neighbors": ("neighbors", ["entity"]),
    "sources": ("get_sources", ["page"]),
    "contradictions": ("find_contradictions", []),
    "dossier": ("compose_dossier", ["query"]),
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quarry")
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("compile")
    build.add_argument("--index", required=True)
    build.add_argument("--kb", required=True)
    build.add_argument("--pdf-runs", required=True)
    build.add_argument("--web-runs", required=True)
    for name, (_, args) in TOOLS.items():
        tool = commands.add_parser(name)
        tool.add_argument("--index", required=True)
        tool.add_argument("--rows", type=int, default=100, help="rows of the answer to print")
        for a in args:
            tool.add_argument(f"--{a}", required=True)
    given = parser.parse_args(argv)
    spark = session()
    if given.command == "compile":
        print(json.dumps(compile_index(spark, given.index, given.kb, {"pdf": given.pdf_runs, "web": given.web_runs})))
        return 0
    method, args = TOOLS[given.command]
    for line in getattr(Index(spark, given.index), method)(**{a: getattr(given, a) for a in args}).limit(given.rows).toJSON().toLocalIterator():
        print(line)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
