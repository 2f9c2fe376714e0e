"""Load and batch ids: ``YYYYMMDD_HHMM_letters_uuid``."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascending_letters(moment: dt.datetime) -> str:
    """Four letters that grow with the millisecond inside the minute."""
    left = moment.second * 1000 + moment.microsecond // 1000
    letters = ""
    for _ in range(4):
        left, digit = divmod(left, 26)
        letters = chr(ord("A") + digit) + letters
    return letters


def make_stamp(moment: dt.datetime | None = None) -> str:
    moment = moment or dt.datetime.now()
    return f"{moment:%Y%m%d_%H%M}_{ascending_letters(moment)}"


def make_batch_id() -> str:
    return f"{make_stamp()}_{uuid.uuid4()}"


def load_id(stamp: str, run_uuid: str, uri: Column) -> Column:
    """One id per file and run.

    The uuid part is a hash of run and file, not ``uuid()``: a task that is run
    again after a lost executor must give the same id to the rows of its file.
    """
    digest = F.md5(F.concat(F.lit(run_uuid + "|"), uri))
    parts = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit(stamp + "_"), F.concat_ws("-", *parts))
