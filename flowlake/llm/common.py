"""Helpers the operators share: tables, written cuts of the lineage, whole groups in a stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.config import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str, max_rows: int = 0) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    A lost executor then costs the tasks it ran, not the steps before. Files hold at most
    ``max_rows`` rows; 0 sets no bound.
    """
    path = shared_folder(df.sparkSession, f"llm-{purpose}")
    df.write.option("maxRecordsPerFile", max_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """A column's name as Spark reads it, whatever letters it holds."""
    return "`" + name.replace("`", "``") + "`"


def all_columns(df: DataFrame) -> list[Column]:
    return [F.col(quoted(c)).alias(c) for c in df.columns]


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with the first number that makes it unlike the names ``df`` has."""
    taken = {c.lower() for c in df.columns}
    names = [wanted, *(f"{wanted}_{n}" for n in range(len(taken) + 1))]
    return next(n for n in names if n.lower() not in taken)


def crc_remainder(key: str | Column, modulus: int) -> Column:
    """crc32 of a key's text modulo ``modulus``; a null key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def text_bytes(name: str = "text") -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def smallest_text(name: str = "text") -> Column:
    """Of a group's texts the one with the smallest hash."""
    return F.min_by(name, F.struct(F.xxhash64(name), name))


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str],
                 least: int = 20_000) -> Iterator[pd.DataFrame]:
    """Regroup batches that are sorted by ``keys`` so that no group is split.

    Each frame holds whole groups and ``least`` rows or more, the last one excepted.
    Callers bound the size of a group before they sort.
    """
    held: list[pd.DataFrame] = []
    rows = 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        rows += len(batch)
        if rows < least:
            continue
        frame = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
        last = frame[keys].iloc[-1]
        same = np.logical_and.reduce([frame[k].to_numpy() == last[k] for k in keys])
        cut = len(frame) - int(same[::-1].argmin() if not same.all() else len(frame))
        if cut:
            yield frame.iloc[:cut].reset_index(drop=True)
        held, rows = [frame.iloc[cut:]], len(frame) - cut
    if rows:
        yield pd.concat(held, ignore_index=True)


def group_starts(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new group begins, and the number of rows at the end."""
    new = np.zeros(len(frame), bool)
    new[:1] = True
    for k in keys:
        v = frame[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), len(frame))
