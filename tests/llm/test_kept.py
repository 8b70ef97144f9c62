"""What tasks keep in a worker process goes when another operator's tasks run in it."""

import public_tokenizers
from pyspark.sql import functions as F

from ferrytab.llm import bpe, jaccard


def held(session):
    """How many tools the worker processes hold, a row per task."""

    def look(batches):
        import time

        import pyarrow as pa

        from ferrytab.llm import bpe, common

        for batch in batches:
            time.sleep(0.05)  # so that all processes get tasks
            n = len(getattr(common, "_KEPT", ())) + len(getattr(bpe, "_ENCODERS", ()))
            yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    return [r["n"] for r in session.range(0, 32, 1, 32).mapInArrow(look, "n long").collect()]


def test_encoders_go_when_other_operators_run(session, frame):
    docs = frame([(i, f"some words of text number {i} and more") for i in range(64)]).repartition(32)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokenizer = bpe.ByteBpe(session, path, public_tokenizers.PATTERN)
    assert docs.select(F.size(tokenizer.encode(F.col("text"))).alias("n")).agg(F.sum("n")).first()[0] > 0
    assert sum(held(session)) > 0  # tasks of one operator find their tool again
    jaccard._repeating(docs, 85, 4)
    assert sum(held(session)) == 0
