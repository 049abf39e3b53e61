"""Headline jobs on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Every job runs on the whole corpus and is forced to completion (noop sink or
a collect of a bounded result). Timings exclude JVM start.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from speechlens.operators import clusters as CL  # noqa: E402
from speechlens.operators import consolidate as C  # noqa: E402
from speechlens.operators import keywords as K  # noqa: E402
from speechlens.operators import search as S  # noqa: E402
from speechlens.operators import similarity as M  # noqa: E402
from speechlens.operators import topics as TP  # noqa: E402
from speechlens.plans.workspace import Workspace  # noqa: E402
from speechlens.session import get_session, scratch_path  # noqa: E402
from speechlens.sources import speeches as SP  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", max(4, cpus))
    spark.range(10).count()  # warm-up
    # every job is measured from the tables: nothing that an earlier run has written counts
    spark.conf.set("spark.speechlens.artifact.dir", scratch_path(spark, "bench"))
    ws = Workspace(spark, sf_dir)
    docs = ws.docs()
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    timed("consolidate", lambda: run(C.consolidate(SP.documents_as_speeches(ws.table("documents")))))
    timed("tfidf_fit", lambda: (ws.model(), ws.display()))
    m = ws.model()
    bench_q = ws.table("benchmark").select("item_id", "text").withColumnRenamed("item_id", "query_id")
    first = bench_q.orderBy("query_id").limit(1).first()["text"]
    timed("search_one", lambda: S.search_text(spark, m, ws.display(), first).collect())
    timed("search_batch", lambda: S.search(m, ws.display(), bench_q).collect())

    def keywords():
        per_doc = K.keywords_per_doc(m.weights, docs, carry=("member_name", "political_party")).persist()
        run(per_doc)
        run(K.keywords_per_member(per_doc, docs))
        run(K.keywords_per_party(per_doc, docs))
        run(K.keyword_trend(per_doc, docs))
        per_doc.unpersist()

    timed("keywords", keywords)
    timed("similar_pairs", lambda: M.similar_pairs(M.member_vectors(m.weights, docs), 10, 0.6).collect())
    timed("lsa_topics", lambda: TP.topics(ws.lsa(), m.vocabulary).collect())
    timed("kmeans_clusters", lambda: CL.cluster_examples(ws.clusters(10), docs, 10).collect())

    total = round(sum(times.values()), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_job_time", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
