"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir, shuffle_partitions

__all__ = ["CRC_TABLE", "class_fractions", "crc32_sql", "ensure_checkpoint_dir", "fraction_for", "hash_share", "hash_share_by", "md_key", "read", "remainder", "shuffle_partitions", "stored"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the session's shared checkpoint folder and read it
    back: later reads survive lost executors, and its exact size is known to the planner."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def md_key(*cols: Column) -> Column:
    """128-bit key of a whole row of values; null differs from the empty string."""
    return F.unhex(F.md5(F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)])).cast("binary")))


def fraction_for(bound: int, total: int) -> float:
    """Share of rows to take so that about ``bound`` of ``total`` rows are kept (1: all)."""
    return 1.0 if total <= bound else bound / total


def hash_share(col: Column, share: float, seed: int) -> Column:
    """A repeatable choice of about ``share`` of the rows, by a hash of ``col``."""
    if share >= 1.0:
        return F.lit(True)
    return F.pmod(F.xxhash64(col, F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30))


def class_fractions(bound: int, counts: dict) -> dict:
    """Shares of each class to take so that about ``bound`` rows are kept in all: small classes
    whole, the others down to one size."""
    left, out = float(bound), {}
    for i, (key, n) in enumerate(sorted(counts.items(), key=lambda kv: kv[1])):
        most = left / (len(counts) - i)
        out[key] = 1.0 if n <= most else most / n
        left -= min(n, most)
    return out


def hash_share_by(col: Column, kind: Column, shares: dict, seed: int) -> Column:
    """``hash_share`` with a share for each value of ``kind``; other values are not chosen."""
    if not shares:
        return F.lit(False)
    limits = F.create_map(*[F.lit(x) for key, share in shares.items() for x in (key, int(share * (1 << 30)))])
    return F.coalesce(F.pmod(F.xxhash64(col, F.lit(seed)), F.lit(1 << 30)) < F.try_element_at(limits, kind), F.lit(False))


#: For the SQL texts (DuckDB has no crc32): a common table expression with the 256 values of the
#: reflected polynomial 0xEDB88320, built by its rule, and the value of a text by that table.
CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda b: list_reduce(
  list_concat([b], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def crc32_sql(text: str) -> str:
    """crc32 of the UTF-8 bytes of the SQL expression ``text``; ``crc_table`` must be in scope."""
    digits = f"hex(encode({text}))"
    bytes_ = (f"list_transform(regexp_extract_all({digits}, '..'), lambda h: "
              "16 * (strpos('0123456789ABCDEF', h[1]) - 1) + strpos('0123456789ABCDEF', h[2]) - 1)")
    return (f"xor(list_reduce(list_concat([4294967295], {bytes_}), "
            "lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295)")
