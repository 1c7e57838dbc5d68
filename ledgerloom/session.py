"""Session defaults the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    # Bad dates and numeric overflow raise instead of turning into nulls.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Joins, partition counts and hot partitions are settled from measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


# Shuffle pieces of about this size sort in memory; adaptive execution merges small ones.
BYTES_PER_PIECE = 256 * 1024**2
LEAST_PIECES = 200


def shuffle_pieces(input_bytes: int) -> int:
    """How many pieces to cut shuffles into for an input of this size."""
    return max(-(-input_bytes // BYTES_PER_PIECE), LEAST_PIECES)


def build_session(
    app_name: str = "ledgerloom", input_bytes: int | None = None, **overrides: str
) -> SparkSession:
    """A session with the defaults above; ``overrides`` use ``__`` in place of dots.

    Give ``input_bytes`` on a cluster: the stock 200 pieces are far too few for terabytes.
    """
    settings = dict(DEFAULTS)
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_pieces(input_bytes))
    settings |= {k.replace("__", "."): v for k, v in overrides.items()}
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
