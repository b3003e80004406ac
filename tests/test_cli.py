import os
import tempfile

from cartograph import cli
from tests.conftest import WORKED_LINES


def test_four_jobs_through_text(spark):
    d = tempfile.mkdtemp(prefix="cartograph-cli-")
    os.makedirs(f"{d}/raw")
    with open(f"{d}/raw/train.csv", "w") as fh:
        fh.write("\n".join(WORKED_LINES) + "\n")
    cli.clean_features(spark, f"{d}/raw", f"{d}/clean", f"{d}/features")
    cli.analysis(spark, f"{d}/clean", f"{d}/task2")
    cli.kmeans_job(spark, f"{d}/features", f"{d}/task3", 2)
    line = cli.personal_rank_job(spark, f"{d}/task2/item_user_inverted_index", f"{d}/clean", 3,
                                 f"{d}/task4")
    assert line == "3\t10:0.124"
    feats = sorted(r["value"] for r in spark.read.text(f"{d}/features").collect())
    assert feats[0] == "-6,0.0000,0.0000,0.3750"
    assert spark.read.text(f"{d}/task2/item_co_occurrence").first()["value"] == "10,9\t1"
    assert spark.read.text(f"{d}/task3/cluster_centers").count() == 2
    assert spark.read.text(f"{d}/task3/user_cluster_labels").count() == 5
