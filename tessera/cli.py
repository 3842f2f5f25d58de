"""Command line for the jobs the reference ran as scripts.

    python -m tessera.cli usercf    --filename ratings.csv [--k 100]
    python -m tessera.cli latent    --filename ratings.csv [--k 100 --lr 0.1 --lambdar 1.0 --epochs 20]
    python -m tessera.cli baselines --filename ratings.csv
    python -m tessera.cli index     --docs docs.json --out /shared/index [--shards 3]
    python -m tessera.cli search    --index /shared/index --q "hill" [--person]

Ratings files use the ``userId,movieId,rating,timestamp`` CSV layout; docs are
JSON lines with ``doc_id, title, text, actors, directors, writer``.  ``--master``
is only for local runs; on a cluster spark-submit supplies it.  Results print as
rows (MSE per split, or the search JSON envelope).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session(master: str | None) -> SparkSession:
    from tessera.session import ensure_checkpoint_dir, ship_package
    b = (SparkSession.builder.appName("tessera")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _ratings(spark, path):
    from tessera.operators import ratings as rt
    from tessera.sources import files
    r = files.read_ratings_csv(spark, path).select("user_id", "item_id", "rating")
    return rt.with_split(rt.dedupe_ratings(r, "max"))


def cmd_usercf(spark, a):
    from tessera.operators import evaluate, neighborhood, ratings as rt
    s = _ratings(spark, a.filename)
    train = rt.split_part(s, "train")
    pairs = s.where(F.col("split") != "train").drop("bucket")
    n_users = s.select(F.countDistinct("user_id")).scalar()
    pred = neighborhood.predict(train, pairs, k=a.k, n_entities=n_users)
    evaluate.mse(pred, by=["split"]).show()


def cmd_latent(spark, a):
    from tessera.operators import evaluate, factors, ratings as rt
    s = _ratings(spark, a.filename)
    train = rt.split_part(s, "train")
    pairs = s.where(F.col("split") != "train").drop("bucket")
    q0, p0, dq, dp = factors.pooled_gd(train, s, k=a.k, lr=a.lr, lam=a.lambdar, epochs=a.epochs)
    pred = factors.predict(pairs, factors.shifted(q0, "q", dq), factors.shifted(p0, "p", dp))
    evaluate.mse(pred, by=["split"]).show()


def cmd_baselines(spark, a):
    from tessera.operators import baselines, evaluate, ratings as rt
    s = _ratings(spark, a.filename)
    train = rt.split_part(s, "train")
    pairs = s.where(F.col("split") != "train").drop("bucket")
    for name, fn in baselines.BASELINES.items():
        evaluate.mse(fn(train, pairs), by=["split"]).withColumn("method", F.lit(name)).show()


def cmd_index(spark, a):
    from tessera.operators import index
    from tessera.sources.tables import DOCS_SCHEMA
    docs = spark.read.schema(DOCS_SCHEMA).json(a.docs)
    index.write_index(*index.build_index(docs, a.shards), a.out)


def cmd_search(spark, a):
    from tessera.operators import index, search
    post, idf, store = index.read_index(spark, a.index)
    q = spark.createDataFrame([(1, a.q)], "query_id long, q string")
    fn = search.search_person if a.person else search.search_plot
    maxima = index.read_maxima(spark, a.index) if "block" in post.columns else None
    res = fn(q, post, idf, store, maxima=maxima)
    for row in search.search_json(q, res, person=a.person).collect():
        print(row.json)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="tessera")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    u = sub.add_parser("usercf")
    u.add_argument("--filename", required=True)
    u.add_argument("--k", type=int, default=100)
    lt = sub.add_parser("latent")
    lt.add_argument("--filename", required=True)
    lt.add_argument("--k", type=int, default=100)
    lt.add_argument("--lr", type=float, default=0.1)
    lt.add_argument("--lambdar", type=float, default=1.0)
    lt.add_argument("--epochs", type=int, default=20)
    b = sub.add_parser("baselines")
    b.add_argument("--filename", required=True)
    ix = sub.add_parser("index")
    ix.add_argument("--docs", required=True)
    ix.add_argument("--out", required=True)
    ix.add_argument("--shards", type=int, default=3)
    se = sub.add_parser("search")
    se.add_argument("--index", required=True)
    se.add_argument("--q", required=True)
    se.add_argument("--person", action="store_true")
    se.add_argument("--shards", type=int, default=3)
    a = p.parse_args(argv)
    spark = _session(a.master)
    {"usercf": cmd_usercf, "latent": cmd_latent, "baselines": cmd_baselines,
     "index": cmd_index, "search": cmd_search}[a.cmd](spark, a)


if __name__ == "__main__":
    main()
