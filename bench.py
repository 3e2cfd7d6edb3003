"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

The stub annotator first writes responses for all documents to a temporary folder,
as an annotation job would; that time is reported as ``prepare`` and is not part of
the total. The queries then work on the stored responses, except ``annotate_python``,
which runs the annotator in Python workers over the documents. Each is run twice into
a sink that discards the rows, and the better time counts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

import morphloom as m
from harness.queries import docs, stoplist
from harness.stub import make_annotator, stub_annotated

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", str(2 * int(CPUS)))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def headline(spark: SparkSession, stored: DataFrame, stops: DataFrame) -> dict:
    def decoded(*fields):
        return m.decode_responses(stored, fields=fields)

    content = {"use_lemma": True, "remove_punct": True, "pos_keep": m.CONTENT_POS}
    return {
        "decode_responses": lambda: decoded("md_lattice"),
        "parse_morphemes": lambda: m.parse(stored),
        "parse_dependencies": lambda: m.parse_dependencies(stored),
        "response_alignment": lambda: m.response_alignment(decoded("md_lattice", "dep_tree")),
        "attach_dependencies": lambda: m.attach_dependencies(
            m.explode_md(decoded("md_lattice")), m.explode_dep(decoded("dep_tree"))
        ),
        "alignment_report": lambda: m.alignment_report(
            m.explode_md(decoded("md_lattice")), m.explode_dep(decoded("dep_tree"))
        ),
        "parse_summary": lambda: m.summary(m.parse(stored)),
        "tokens_from_lattices": lambda: m.text_to_tokens(stored, **content),
        "tokens_lemma": lambda: m.as_tokens(m.parse(stored), **content),
        "token_id_window": lambda: m.with_token_id(
            m.explode_md(decoded("md_lattice")).drop("token_id"), "position"
        ),
        "stopword_removal": lambda: m.remove_stopwords(m.token_rows(m.parse(stored)), stops),
        "dfm_content_lemma": lambda: m.text_to_dfm(stored, stopwords=stops),
        "topfeatures": lambda: m.topfeatures(m.text_to_dfm(stored, stopwords=stops), 25),
        "topfeatures_direct": lambda: m.topfeatures(
            m.content_tokens(m.content_morphemes(decoded("md_lattice")), stopwords=stops), 25
        ),
        "feature_index": lambda: m.feature_index(m.text_to_dfm(stored)),
        "dfm_vectors": lambda: m.dfm_vectors(m.text_to_dfm(stored)),
        "annotate_python": lambda: m.annotate(docs(spark, SF), make_annotator),
    }


def timed(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    with tempfile.TemporaryDirectory(prefix="bench-") as folder:
        start = time.perf_counter()
        stub_annotated(docs(spark, SF)).write.parquet(f"{folder}/responses")
        prepare = time.perf_counter() - start
        stored = m.responses(spark.read.parquet(f"{folder}/responses"))
        stops = stoplist(spark, SF)
        rows = m.summary(m.parse(stored)).first()
        times = {
            name: round(min(timed(build) for _ in range(RUNS)), 3)
            for name, build in headline(spark, stored, stops).items()
        }
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "documents": rows.n_documents,
                "morphemes": rows.n_morphemes,
                "prepare": round(prepare, 3),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
