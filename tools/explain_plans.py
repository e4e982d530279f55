"""Print the physical plans of the main operators (formatted) at a given scale.

usage: python tools/explain_plans.py [sf_dir] > docs/PLANS.txt
"""

import sys

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from driftline.operators.infer import occurrences  # noqa: E402
from driftline.operators.observe import first_by_order  # noqa: E402
from driftline.plans.ingest import ingest  # noqa: E402
from driftline.session import build_session, shared_path  # noqa: E402
from driftline.sources import fixtures as fx  # noqa: E402
from driftline.sources.records import slice_from_offsets  # noqa: E402


def show(title, df):
    print(f"\n==== {title} ====")
    df.explain("formatted")
    sys.stdout.flush()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    recs = fx.all_records(spark, sf, ["orders", "wide_kinds"])
    res = ingest(recs, stage=shared_path(spark, "stage", unique=True))
    show("admission (what the one staging write runs)", ingest(recs).admitted)
    show("name sets: first record of each field, and the census (staged copy, names only)", occurrences(res.admitted))
    show("coercion of table orders (one partition of the staged copy, projection only)", res.rows("orders"))
    show("rejects of a batch", res.rejected())
    show("losses of one table", res.losses("kinds"))
    show("first record per topic", first_by_order(res.admitted, ["topic"], ["offset", "partition"]))
    replay = fx.all_records(spark, sf, ["orders"])
    show("replay: start offsets pushed into the scan",
         slice_from_offsets(replay, {"orders": {"0": 3000, "1": -2, "2": -1}}).select("offset", F.length("value")))


if __name__ == "__main__":
    main()
