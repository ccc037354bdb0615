"""Stage-by-stage command line: each stage reads Parquet tables and writes its
result as Parquet, so the evaluations can be run as separate jobs with stored
hand-over tables between them.

    python -m cadenza.plans.cli clean --interactions I --tracks T --users U --out C
    python -m cadenza.plans.cli split --input C --train TR --validation VA [--ratio 0.8]
    python -m cadenza.plans.cli counts --input TR --out TRC
    python -m cadenza.plans.cli popularity --counts TRC --out TOP [--beta 100000 --k 100]
    python -m cadenza.plans.cli evaluate --validation VA --top TOP [--k 10] [--out M]
    python -m cadenza.plans.cli compress --input TRC --out TRR [--column count]
    python -m cadenza.plans.cli recency --input TR --out TRW
    python -m cadenza.plans.cli index --train TRR --apply VAR --out-train TRI --out-apply VAI
    python -m cadenza.plans.cli als --train TRI --test VAI [--preset counts|recency] [--n 100] [--out P]
    python -m cadenza.plans.cli bias --train TRI --test VAI [--format csv] [--fraction 0.1 --seed 42] [--out P]

Sinks fail when the target exists unless ``--overwrite`` is given.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from cadenza import operators as op
from cadenza.plans import flows
from cadenza.schemas import RATINGS_CSV
from cadenza.session import build_session
from cadenza.sources import read_csv, read_parquet, write_parquet


def _mode(args) -> str:
    return "overwrite" if args.overwrite else "errorifexists"


def _out(df: DataFrame, path: str | None, args) -> None:
    if path:
        write_parquet(df, path, _mode(args))
    else:
        df.show(truncate=False)


def run(spark: SparkSession, args) -> None:
    read = lambda p: read_parquet(spark, p)
    cmd = args.command
    if cmd == "clean":
        _out(op.clean_interactions(read(args.interactions), read(args.tracks), read(args.users)),
             args.out, args)
    elif cmd == "split":
        split = op.temporal_split(read(args.input), args.ratio)
        _out(op.train_part(split), args.train, args)
        _out(op.validation_part(split), args.validation, args)
    elif cmd == "counts":
        _out(op.interaction_counts(read(args.input)), args.out, args)
    elif cmd == "popularity":
        _out(op.popularity_topk(read(args.counts), beta=args.beta, k=args.k), args.out, args)
    elif cmd == "evaluate":
        per_user = op.ranking_metrics(read(args.validation), read(args.top), k=args.k)
        _out(op.ranking_summary(per_user), args.out, args)
    elif cmd == "compress":
        _out(op.compress_rating(read(args.input), args.column), args.out, args)
    elif cmd == "recency":
        cols = ["user_id", "recording_mbid", "timestamp"]
        _out(op.recency_weight(read(args.input).select(*cols), per_item=args.per_item),
             args.out, args)
    elif cmd == "index":
        train = read(args.train)
        index = op.pin(op.fit_item_index(train))
        _out(op.apply_item_index(train, index), args.out_train, args)
        if args.apply:  # items unseen in train are numbered after those of train
            held_out = read(args.apply)
            _out(op.apply_item_index(held_out, op.extend_item_index(index, held_out)),
                 args.out_apply, args)
    elif cmd == "als":
        indexed = flows.Indexed(read(args.train), read(args.test), None)
        if args.preset == "recency":
            result = op.exact_auc(flows.recency_scores(indexed, args.threshold, args.per_event))
        else:
            result = flows.als_evaluation(indexed, n=args.n)
        _out(result, args.out, args)
    elif cmd == "bias":
        if args.format == "csv":
            read = lambda p: read_csv(spark, p, RATINGS_CSV)
        indexed = flows.Indexed(read(args.train), read(args.test), None)
        _out(flows.bias_evaluation(indexed, args.fraction, args.seed, n=args.n), args.out, args)
    else:  # pragma: no cover - argparse rejects unknown commands
        raise ValueError(cmd)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cadenza")
    p.add_argument("--overwrite", action="store_true", help="replace existing outputs")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("clean")
    for name in ("interactions", "tracks", "users", "out"):
        s.add_argument(f"--{name}", required=name != "out")
    s = sub.add_parser("split")
    s.add_argument("--input", required=True)
    s.add_argument("--train", required=True)
    s.add_argument("--validation", required=True)
    s.add_argument("--ratio", type=float, default=0.8)
    s = sub.add_parser("counts")
    s.add_argument("--input", required=True)
    s.add_argument("--out")
    s = sub.add_parser("popularity")
    s.add_argument("--counts", required=True)
    s.add_argument("--out")
    s.add_argument("--beta", type=float, default=100000)
    s.add_argument("--k", type=int, default=100)
    s = sub.add_parser("evaluate")
    s.add_argument("--validation", required=True)
    s.add_argument("--top", required=True)
    s.add_argument("--k", type=int, default=10)
    s.add_argument("--out")
    s = sub.add_parser("compress")
    s.add_argument("--input", required=True)
    s.add_argument("--out")
    s.add_argument("--column", default="count")
    s = sub.add_parser("recency")
    s.add_argument("--input", required=True)
    s.add_argument("--out")
    s.add_argument("--per-item", action="store_true")
    s = sub.add_parser("index")
    s.add_argument("--train", required=True)
    s.add_argument("--apply")
    s.add_argument("--out-train", required=True)
    s.add_argument("--out-apply")
    s = sub.add_parser("als")
    s.add_argument("--train", required=True)
    s.add_argument("--test", required=True)
    s.add_argument("--preset", choices=["counts", "recency"], default="counts")
    s.add_argument("--n", type=int, default=100)
    s.add_argument("--threshold", type=float, default=4.0)
    s.add_argument("--per-event", action="store_true")
    s.add_argument("--out")
    s = sub.add_parser("bias")
    s.add_argument("--train", required=True)
    s.add_argument("--test", required=True)
    s.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    s.add_argument("--fraction", type=float, default=0.1)
    s.add_argument("--seed", type=int, default=42)
    s.add_argument("--n", type=int, default=100)
    s.add_argument("--out")
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(args.master, app_name=f"cadenza-{args.command}")
    run(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
