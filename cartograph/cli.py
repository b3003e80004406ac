"""Command line: the four jobs with the original arguments and text formats.

    spark-submit --py-files cartograph.zip -m cartograph.cli clean-features <input> <cleanOut> <featureOut>
    python -m cartograph.cli analysis <cleanOut> <outputBase>
    python -m cartograph.cli kmeans <features> <output> <k>
    python -m cartograph.cli personal-rank <invertedIndex> <cleanLog> <targetUser> <output>

Outputs are folders of text part files (overwritten); ``analysis`` writes
``<outputBase>/item_user_inverted_index`` and ``<outputBase>/item_co_occurrence``;
``kmeans`` writes ``<output>/cluster_centers`` and ``<output>/user_cluster_labels``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("cartograph").getOrCreate()
    from cartograph.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return spark


def clean_features(spark, input_path: str, clean_out: str, feature_out: str) -> None:
    from cartograph.operators.clean import clean_text
    from cartograph.operators.features import user_features
    from cartograph.sinks import writers
    from cartograph.sources import readers
    clean = clean_text(readers.read_raw_log(spark, input_path))
    writers.write_clean_log_text(clean, clean_out)
    clean = readers.read_clean_log_text(spark, clean_out)
    writers.write_features_text(user_features(clean), feature_out)


def analysis(spark, clean_in: str, output_base: str, top_n: int = 1000) -> None:
    from cartograph.operators import cooccur, index
    from cartograph.sinks import writers
    from cartograph.sources import readers
    clean = readers.read_clean_log_text(spark, clean_in)
    base = output_base.rstrip("/")
    writers.write_index_text(index.inverted_index(clean), f"{base}/item_user_inverted_index")
    writers.write_pairs_text(cooccur.top_pairs(clean, top_n), f"{base}/item_co_occurrence")


def kmeans_job(spark, features_in: str, output: str, k: int) -> None:
    from cartograph.operators import kmeans
    from cartograph.sinks import writers
    from cartograph.sources import readers
    feats = readers.read_feature_fields(spark, features_in)
    model = kmeans.fit(feats, k)
    out = output.rstrip("/")
    writers.write_centers_text(kmeans.centers_frame(spark, model.centers), f"{out}/cluster_centers")
    writers.write_labels_text(kmeans.labels(feats, model.centers), f"{out}/user_cluster_labels")
    print(f"k-means: {model.iterations} rounds, converged={model.converged}")


def personal_rank_job(spark, index_in: str, clean_in: str, target: str | int, output: str) -> str:
    from cartograph.operators import personal_rank
    from cartograph.sinks import writers
    from cartograph.sources import readers
    target = str(target)
    edges = readers.read_index_fields(spark, index_in)
    seen = personal_rank.seen_items_text(spark.read.text(clean_in), target)
    top = personal_rank.recommend_text(edges, seen, target)
    writers.write_recommendation(personal_rank.recommendation_line(top, target), output)
    line = spark.read.text(output).first()["value"]
    print(line)
    return line


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="cartograph")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("clean-features"); a.add_argument("input"); a.add_argument("clean_out"); a.add_argument("feature_out")
    a = sub.add_parser("analysis"); a.add_argument("clean_out"); a.add_argument("output_base")
    a = sub.add_parser("kmeans"); a.add_argument("features"); a.add_argument("output"); a.add_argument("k", type=int)
    a = sub.add_parser("personal-rank"); a.add_argument("index"); a.add_argument("clean_log")
    a.add_argument("target"); a.add_argument("output")
    args = p.parse_args(argv)
    spark = _session()
    if args.job == "clean-features":
        clean_features(spark, args.input, args.clean_out, args.feature_out)
    elif args.job == "analysis":
        analysis(spark, args.clean_out, args.output_base)
    elif args.job == "kmeans":
        kmeans_job(spark, args.features, args.output, args.k)
    else:
        personal_rank_job(spark, args.index, args.clean_log, args.target, args.output)


if __name__ == "__main__":
    main(sys.argv[1:])
