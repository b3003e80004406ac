"""The four jobs in their original order, handing over through files.

    clean + features  ->  index + top pairs  ->  k-means  ->  PersonalRank recommendation

``handover="text"`` writes and re-reads the exported line formats (K1-K4, S2-S4), as the
original jobs do; ``handover="parquet"`` keeps typed parquet between the jobs (faster,
prunes columns and pushes filters). Every output is written with overwrite semantics.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cartograph.operators import cooccur, features, index, kmeans, personal_rank
from cartograph.sinks import writers
from cartograph.sources import readers


@dataclass
class BatchResult:
    paths: dict[str, str] = field(default_factory=dict)
    kmeans: kmeans.KMeansModel | None = None
    recommendation: str | None = None


def run_jobs(spark: SparkSession, clean_or_raw: DataFrame, out_dir: str, target: int,
             k: int = 5, top_n: int = cooccur.DEFAULT_TOP_N, rec_n: int = 10,
             handover: str = "text", is_raw_text: bool = False) -> BatchResult:
    from cartograph.operators.clean import clean_text

    out = out_dir.rstrip("/")
    res = BatchResult()
    clean = clean_text(clean_or_raw) if is_raw_text else clean_or_raw

    # Job 1: clean log + features
    if handover == "text":
        res.paths["clean"] = writers.write_clean_log_text(clean, f"{out}/clean_log")
        clean = readers.read_clean_log_text(spark, res.paths["clean"])
    else:
        res.paths["clean"] = writers.write_clean_log(clean, f"{out}/clean_log")
        clean = readers.read_clean_log(spark, res.paths["clean"])
    feats = features.user_features(clean)
    res.paths["features"] = writers.write_features_text(feats, f"{out}/user_features")
    if handover == "parquet":
        feats.write.mode("overwrite").parquet(f"{out}/user_features_parquet")

    # Job 2: inverted index + top co-occurring pairs
    idx = index.inverted_index(clean)
    res.paths["index"] = writers.write_index_text(idx, f"{out}/item_user_inverted_index")
    res.paths["pairs"] = writers.write_pairs_text(cooccur.top_pairs(clean, top_n),
                                                  f"{out}/item_co_occurrence")

    # Job 3: k-means on the written features
    if handover == "text":
        fin = readers.read_features_text(spark, res.paths["features"])
    else:
        fin = spark.read.parquet(f"{out}/user_features_parquet")
    res.kmeans = kmeans.fit(fin, k, cut=False)    # written already
    centres = kmeans.centers_frame(spark, res.kmeans.centers)
    res.paths["centers"] = writers.write_centers_text(centres, f"{out}/cluster_centers")
    res.paths["labels"] = writers.write_labels_text(kmeans.labels(fin, res.kmeans.centers),
                                                    f"{out}/user_cluster_labels")

    # Job 4: PersonalRank from the written index and the clean log
    edges = readers.read_index_text(spark, res.paths["index"])
    graph = personal_rank.build_graph(edges)
    try:
        top = personal_rank.recommend(clean, target, rec_n, graph=graph)
        line = personal_rank.recommendation_line(top, target)
        res.paths["recommendation"] = writers.write_recommendation(
            line, f"{out}/recommendation")
        res.recommendation = spark.read.text(res.paths["recommendation"]).first()["value"]
    finally:
        graph.release()
    return res
