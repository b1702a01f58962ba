"""Command line: ``python -m temblor <job> ...``.

Jobs: ``batch`` (raw CSV -> cleaned table -> curated tables), ``train``
(cleaned table -> model), ``metrics`` (message stream -> windowed metrics),
``score`` (message stream -> predictions and alerts), ``check`` (tables and
a preview). Connection settings for JDBC targets come from a JSON file or
environment variables named by the caller, never from this code.
"""

from __future__ import annotations

import argparse
import json
import os

from .session import get_session


def _messages(spark, args):
    from .streaming.runner import kafka_stream, text_stream
    if args.source == "kafka":
        return kafka_stream(spark, args.bootstrap, args.topic, args.starting)
    return text_stream(spark, args.path)


def _jdbc(args):
    if not args.jdbc_options:
        return None
    with open(args.jdbc_options) as fh:
        opts = json.load(fh)
    # values like "$NAME" are read from the environment
    return {k: os.environ.get(v[1:], "") if isinstance(v, str) and v.startswith("$") else v
            for k, v in opts.items()}


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="temblor")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="job", required=True)

    b = sub.add_parser("batch")
    b.add_argument("--raw", required=True)
    b.add_argument("--raw-zone", required=True)
    b.add_argument("--target", choices=["table", "parquet", "jdbc"], default="table")
    b.add_argument("--out", default=None)
    b.add_argument("--jdbc-options", default=None)
    b.add_argument("--as-of", default=None)
    b.add_argument("--split-mechanism", action="store_true")

    t = sub.add_parser("train")
    t.add_argument("--table", default="preprocessed_earthquakes")
    t.add_argument("--parquet", default=None)
    t.add_argument("--model", required=True)
    t.add_argument("--trees", type=int, default=100)
    t.add_argument("--depth", type=int, default=10)

    for name in ("metrics", "score"):
        s = sub.add_parser(name)
        s.add_argument("--source", choices=["files", "kafka"], default="files")
        s.add_argument("--path", default=None)
        s.add_argument("--bootstrap", default=None)
        s.add_argument("--topic", default=None)
        s.add_argument("--starting", default="latest")
        s.add_argument("--out", required=True)
        # A place that outlives the application: a restart resumes from it.
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--trigger", default=None)
        if name == "score":
            s.add_argument("--model", required=True)
        else:
            s.add_argument("--watermark", default="2 hours")

    c = sub.add_parser("check")
    c.add_argument("--database", default="default")
    c.add_argument("--table", default="preprocessed_earthquakes")

    args = p.parse_args(argv)
    spark = get_session(args.master, app=f"temblor-{args.job}")
    from .plans import apps

    if args.job == "batch":
        out = apps.run_batch(spark, args.raw, args.raw_zone, target=args.target,
                             out_root=args.out, jdbc=_jdbc(args), as_of=args.as_of,
                             split_mechanism=args.split_mechanism)
        print(json.dumps(out))
    elif args.job == "train":
        df = spark.read.parquet(args.parquet) if args.parquet else spark.table(args.table)
        print(json.dumps(apps.run_training(spark, df, args.model, args.trees, args.depth),
                         default=str))
    elif args.job == "metrics":
        apps.start_metrics(_messages(spark, args), args.out, args.checkpoint,
                           trigger=args.trigger or "60 seconds", watermark=args.watermark)
        spark.streams.awaitAnyTermination()
    elif args.job == "score":
        q = apps.start_scoring(spark, _messages(spark, args), args.model, args.out,
                               args.checkpoint,
                               trigger=args.trigger or "30 seconds")
        q.awaitTermination()
    elif args.job == "check":
        print(json.dumps(apps.check_tables(spark, args.database, args.table), default=str))


if __name__ == "__main__":
    main()
