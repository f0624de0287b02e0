"""Runs operators over an input whose tasks fail at their first attempt, and
prints one digest per operator and input; ``test_faults`` starts it."""

import hashlib
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from spacetime.llm import language_id, mixing, secret_scan, simhash, substring_dedup, suffix_dedup, token_counts  # noqa: E402
from spacetime.session import build_session  # noqa: E402


def flaky(batches):
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() % 2 == 0:
        raise RuntimeError("injected")
    yield from batches


def main():
    spark = build_session("local[4,4]", app="llm-faults", shuffle_partitions=4, extra={"spark.checkpoint.dir": sys.argv[1]})
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(4, "doc_id")
    ops = {
        "substring": lambda d: substring_dedup.substring_dedup(d),
        "suffix": lambda d: suffix_dedup.suffix_dedup(d),
        "simhash": lambda d: simhash.simhash_components(d),
        "tokens": lambda d: token_counts.token_counts(d),
        "mix": lambda d: mixing.mix(d).drop("target"),
        "secrets": lambda d: secret_scan.find_secrets(d, secret_scan.train(d)),
        "language": lambda d: language_id.predict(d, language_id.train(d, F.lit(True))).drop("score"),
    }
    for name, op in ops.items():
        got = []
        for source in (docs, docs.mapInArrow(flaky, docs.schema)):
            rows = sorted(map(str, op(source).collect()))
            got.append(hashlib.sha256("\n".join(rows).encode()).hexdigest())
        print("RESULT", name, len(rows), got[0] == got[1])
    spark.stop()


if __name__ == "__main__":
    main()
