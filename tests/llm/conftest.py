"""Shared fixtures: small tables with every awkward row in them."""

import pytest
from awkward_rows import DOCS, documents


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(documents(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(awkward):
    """The same rows with columns named like those the operators make."""
    from pyspark.sql import functions as F
    names = ["fp", "key", "n", "node", "size", "shard", "slot", "run", "at", "score", "held_out", "lang_pred", "lang_score",
             "label", "quality", "ids", "start", "length", "sequence_id", "offset", "part", "draw", "row", "far", "h",
             "root", "component_id", "fingerprint", "license", "text_crc32", "vec", "embedding"]
    return awkward.select("*", *[F.lit("clash").alias(c) for c in names])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
