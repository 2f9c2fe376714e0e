"""Incremental load: what is listed and not yet loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.uris import decoded_uri

LOADED = "loaded"
FAILED = "failed"
# Ledger column with the path a file was read from, as listed.
SOURCE = "source_path"


def loaded_files(ledger: DataFrame) -> DataFrame:
    """``zip_uri`` and ``source_path`` of what is loaded; the path is null in rows of older ledgers."""
    path = F.col(SOURCE) if SOURCE in ledger.columns else F.lit(None).cast("string")
    return ledger.where(F.col("status") == LOADED).select("zip_uri", path.alias(SOURCE))


def pending_files(listing: DataFrame, ledger: DataFrame, decode_uris: bool = True) -> DataFrame:
    """Listed files without a ``loaded`` ledger row, one row per ``path``.

    ``zip_uri`` is the decoded path, or the path itself where several listed paths
    decode to the same. Keeps ``path``, which is what has to be read, and ``length``.
    A file is loaded if the ledger has its path. A ledger row without a path covers the
    file that has its ``zip_uri``; of several that decode to it, the one whose path it is.
    Failed files come back until they load.
    """
    uri = decoded_uri(F.col("path")) if decode_uris else F.col("path")
    # The few paths of one URI meet in a row: this tells those that are not alone without a second shuffle.
    files = listing.groupBy(uri.alias("_decoded")).agg(F.collect_set(F.struct("path", "length")).alias("_files"))
    latest = F.filter("_files", lambda f: ~F.exists("_files", lambda g: (g["path"] == f["path"]) & (g["length"] > f["length"])))
    alone = F.size(F.array_distinct(F.col("_files.path"))) == 1
    listed = files.select(F.when(alone, F.col("_decoded")).alias("_uri"), F.inline(latest))
    listed = listed.select(F.coalesce("_uri", "path").alias("zip_uri"), "path", "length")
    done = loaded_files(ledger)
    known = done.where(F.col(SOURCE).isNotNull()).select(F.col(SOURCE).alias("path"))
    return listed.join(known, "path", "left_anti").join(done.where(F.col(SOURCE).isNull()), "zip_uri", "left_anti").select("zip_uri", "path", "length")
