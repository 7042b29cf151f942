"""Command line: wiki, cpt, qa, upload."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusloom")
    sub = p.add_subparsers(dest="command", required=True)
    wiki = sub.add_parser("wiki", help="articles about a keyword from a dump")
    wiki.add_argument("--input", "-i", required=True)
    wiki.add_argument("--output", "-o", required=True)
    wiki.add_argument("--keyword", "-k", required=True)
    wiki.add_argument("--content-threshold", "-t", type=int, default=3)
    for name, text in (("cpt", "chunk data"), ("qa", "questions and answers")):
        c = sub.add_parser(name, help=text)
        c.add_argument("-p", "--settings_path", "--settings-path", required=True)
        c.add_argument("-s", "--source", required=True)
        if name == "qa":
            c.add_argument("-t", "--target_key", "--target-key", default="content")
            c.add_argument("-i", "--start_index", "--start-index", type=int, default=1)
    up = sub.add_parser("upload", help="stage data sets for publication")
    up.add_argument("-r", "--repo_id", "--repo-id", default="")
    up.add_argument("-t", "--hf_token", "--hf-token", default="")
    up.add_argument("-d", "--dataset_dir", "--dataset-dir", required=True)
    up.add_argument("-p", "--staging", help="folder of the staged files; upload_staging in the data set's folder if left out")
    up.add_argument("--private", action="store_true")
    up.add_argument("--include-splits", action="store_true")
    up.add_argument("--dry-run", action="store_true")
    up.add_argument("--commit-message", default="Upload dataset")
    return p


def main(argv: list[str] | None = None, client=None, publish=None) -> int:
    """Runs a command in the active session, or in one with the settings of spark-submit; client and publish replace the HTTP client and the hub."""
    args = _parser().parse_args(argv)
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName("corpusloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    from .operators.chat import HttpChat
    from .plans import cpt, qa
    from .settings import CptSettings, Endpoint, QaSettings, load_yaml
    from .sources import sinks, wiki

    try:
        if args.command == "wiki":
            found = wiki.articles(wiki.read_dump(spark, args.input), args.keyword, args.content_threshold)
            sinks.overwrite_json(found.drop("match_reason"), args.output)
        elif args.command == "cpt":
            raw = load_yaml(args.settings_path)
            settings = CptSettings.of({"max_in_flight": Endpoint.of(raw).max_in_flight, **raw})
            thinking = {} if settings.enable_thinking is None else dict.fromkeys(("to_bullet_points", "bullet_points_to_text"), settings.enable_thinking)
            chat = client or (HttpChat(Endpoint.of(raw), thinking) if settings.copyright_mitigation else None)
            print(cpt.build(spark, args.source, settings, chat))
        elif args.command == "qa":
            raw = load_yaml(args.settings_path)
            settings = QaSettings.of(raw)
            endpoint = Endpoint.of(raw, max_retries=8, wait_seconds=0.25, retry_jitter_seconds=raw.get("wait_seconds", 0.25))
            print(qa.generate(spark, args.source, args.target_key, settings, client or HttpChat(endpoint, dict(settings.thinking)), args.start_index, endpoint.max_in_flight))
        else:
            if not args.dry_run and not args.hf_token:
                raise FileNotFoundError("a token is needed unless it is a dry run")
            publish = publish or sinks.hub_publisher(args.repo_id, args.hf_token, args.private, args.commit_message)
            staging = args.staging or f"{args.dataset_dir.rstrip('/')}/upload_staging"
            sinks.stage_upload(spark, args.dataset_dir, staging, args.include_splits, publish, args.dry_run).show(truncate=False)
    except FileNotFoundError as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
