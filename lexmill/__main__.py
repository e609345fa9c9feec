"""Command line: ``worker`` imports a folder, ``query TITLE`` prints the lists of a document, ``check`` looks at backends."""

from __future__ import annotations

import argparse
import sys

from lexmill.config import Settings


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("lexmill").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def query(settings: Settings, title: str) -> int:
    """Print status, counts and lists of the document with a title; 1 if there is none."""
    from lexmill.operators import registry as R
    from lexmill.streaming.worker import State

    state = State(_session(), settings.state_dir)
    registry = state.table("registry")
    document = R.by_value(registry, "title", title).first()
    if document is None:
        print(f"not found: {title}", file=sys.stderr)
        return 1
    children = state.table("children").withColumnRenamed("pos", "id")
    lists = R.report_lines(R.lists_by_title(registry, children, title)).orderBy("kind", "pos").collect()
    print(f"{document['filename']} [{document['status']}], pages: {document['page_count']}, pairs: {len(lists)}")
    for r in lists:
        print(f"  {r['kind']}: {r['line']}")
    return 0


def check(settings: Settings) -> int:
    """Say which backends are there."""
    from lexmill.sources.recognition import BackendMissing, model_listed, pymupdf_rasteriser, served_models

    bad = 0
    try:
        pymupdf_rasteriser()
        print("rasteriser: found")
    except BackendMissing as e:
        bad, _ = 1, print(f"rasteriser: {e}")
    if settings.extractor == "llm":
        try:
            found = model_listed(served_models(settings.llm_base_url), settings.llm_model)
        except OSError as e:
            bad, found = 1, print(f"model server: {e}") or False
        bad |= not found
        print(f"model {settings.llm_model}: {'found' if found else 'missing'}")
    return int(bad)


def worker(settings: Settings, backends: str) -> int:
    """Import without end; ``backends`` names a module with ``rasteriser()`` and ``detector()``."""
    import importlib

    from lexmill.streaming.worker import run_files

    module = importlib.import_module(backends)
    state = settings.state_dir
    run_files(_session(), settings.input_dir, state, f"{state}/checkpoint", module.rasteriser, module.detector, settings, poll=True).awaitTermination()
    return 0


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lexmill")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("worker").add_argument("backends")
    commands.add_parser("query").add_argument("title")
    commands.add_parser("check")
    given, settings = parser.parse_args(arguments), Settings.from_env()
    if given.command == "query":
        return query(settings, given.title)
    return worker(settings, given.backends) if given.command == "worker" else check(settings)


if __name__ == "__main__":
    sys.exit(main())
