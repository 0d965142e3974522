"""Command-line runs: exact or approximate kNN on rating text files. Each
writes one JSON document through Spark's writer.

    python -m knnrec.apps exact --train T --test S --k 10 --json OUT \\
        [--sep '\\t'] [--sims 1:864,1:886] [--predict 1:1,327:2]
    python -m knnrec.apps approximate ... --partitions 10 --replication 2

Ids on the command line are 1-based, as in the files.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knnrec.operators.evaluate import mae
from knnrec.operators.predict import score_pairs
from knnrec.operators.similarity import similarity_lookup
from knnrec.plans.approximate import fit_approx
from knnrec.plans.exact import fit_exact
from knnrec.session import DEFAULT_CONF, ensure_checkpoint_dir, release_all
from knnrec.sources.ratings import read_rating_text
from knnrec.sources.report import write_report

def _pairs(spark: SparkSession, text: str, left: str, right: str) -> DataFrame:
    """``"1:864,1:886"`` -> 0-based id pairs (a literal typed by the user)."""
    rows = []
    for item in filter(None, (x.strip() for x in (text or "").split(","))):
        a, b = item.split(":")
        rows.append((int(a) - 1, int(b) - 1, item))
    return spark.createDataFrame(rows, f"{left} long, {right} long, name string")


def knn_report(spark: SparkSession, args: argparse.Namespace, approximate: bool) -> DataFrame:
    train = read_rating_text(spark, args.train, args.sep)
    test = read_rating_text(spark, args.test, args.sep)
    n_users = args.users if args.users else None
    if approximate:
        model = fit_approx(train, args.k, args.partitions, args.replication, n_users=n_users,
                           persist=args.persist, duplicates=args.duplicates)
    else:
        model = fit_exact(train, args.k, n_users=n_users, persist=args.persist, duplicates=args.duplicates)
    sims = similarity_lookup(model.neighbors, _pairs(spark, args.sims, "u", "v").drop("name"))
    sims = sims.join(_pairs(spark, args.sims, "u", "v"), ["u", "v"]).select("name", "sim")
    preds = score_pairs(_pairs(spark, args.predict, "u", "i"), model).select("name", "prediction")
    err = mae(score_pairs(test, model))
    meta = F.struct(
        F.lit(args.train).alias("train"), F.lit(args.test).alias("test"), F.lit(args.k).alias("k"),
        model.n_users.alias("users"), F.lit(spark.sparkContext.master).alias("master"),
        *([F.lit(args.partitions).alias("partitions"), F.lit(args.replication).alias("replication")]
          if approximate else []),
    )
    return err.select(
        meta.alias("meta"),
        sims.agg(F.map_from_entries(F.collect_list(F.struct("name", "sim")))).scalar().alias("similarities"),
        preds.agg(F.map_from_entries(F.collect_list(F.struct("name", "prediction")))).scalar()
        .alias("predictions"),
        F.col("mae"), F.col("n_test"),
    )


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="knnrec.apps")
    sub = parser.add_subparsers(dest="app", required=True)
    for name in ("exact", "approximate"):
        p = sub.add_parser(name)
        p.add_argument("--train", required=True)
        p.add_argument("--test", required=True)
        p.add_argument("--json", required=True, help="output folder (JSON lines)")
        p.add_argument("--k", type=int, default=10)
        p.add_argument("--sep", default="\t")
        p.add_argument("--users", type=int, default=0, help="declared user count (0: from train)")
        p.add_argument("--sims", default="", help="pairs like 1:864,1:886")
        p.add_argument("--predict", default="", help="pairs like 1:1,327:2")
        p.add_argument("--master", default=None)
        p.add_argument("--duplicates", choices=["avg", "sum", "error"], default="avg",
                       help="what several train lines of one (user, item) mean")
        p.add_argument("--persist", choices=["table", "persist", "checkpoint", "none"], default="table",
                       help="checkpoint: write intermediates to spark.checkpoint.dir (cuts lineage)")
        if name == "approximate":
            p.add_argument("--partitions", type=int, default=10)
            p.add_argument("--replication", type=int, default=2)
    args = parser.parse_args(argv)

    builder = SparkSession.builder.appName(f"knnrec-{args.app}")
    if args.master:
        builder = builder.master(args.master)
    spark = builder.getOrCreate()
    for key, value in DEFAULT_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    write_report(knn_report(spark, args, approximate=args.app == "approximate"), args.json)
    release_all()


if __name__ == "__main__":
    main()
