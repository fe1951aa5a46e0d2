"""Row-level cleaning operators.  All are narrow (map-only) except ``dedup`` (one hash
aggregate with partial aggregation, i.e. map-side combine before the shuffle)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions._util import recode


def dedup(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (hash of all columns; no sort)."""
    return df.dropDuplicates()


_SEP, _ESC, _PACKED = "\x1f", "\x1b", "__packed"


def _c(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def _to_cell(c):
    """A text without separators; null is ESC 2."""
    return F.coalesce(F.replace(F.replace(c, F.lit(_ESC), F.lit(_ESC + "0")), F.lit(_SEP), F.lit(_ESC + "1")), F.lit(_ESC + "2"))


def _to_hex_cell(c):
    """The cell of a row with bytes that are no UTF-8, which ``split`` would not keep: ESC 3 and hex digits for such texts."""
    return F.when(F.is_valid_utf8(F.coalesce(c, F.lit(""))), _to_cell(c)).otherwise(F.concat(F.lit(_ESC + "3"), F.hex(c)))


def _from_cell(c):
    plain = F.replace(F.replace(c, F.lit(_ESC + "1"), F.lit(_SEP)), F.lit(_ESC + "0"), F.lit(_ESC))
    return (F.when(~c.contains(_ESC), c).when(c == _ESC + "2", F.lit(None))
            .when(c.startswith(_ESC + "3"), F.unhex(F.substr(c, F.lit(3))).cast("string")).otherwise(plain))


def pack_text(df: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """(``df`` with its text columns joined to one, the function that takes a frame with that column back).

    For rows on their way through a shuffle: every text column of a row costs 8 bytes and padding there, much for short
    texts.  Nothing is lost: separators inside texts are escaped, null and empty differ, bytes stay as they are, and packed
    texts are equal exactly where the columns are.  Columns that the frame has got meanwhile go behind the others.
    Fewer than 2 text columns are left alone.  Unpacking is one ``transform`` over an array, which keeps the generated code small."""
    order = df.columns
    text = [f.name for f in df.schema if f.dataType == StringType()]
    if len(text) < 2 or len({c.lower() for c in order}) < len(order):
        return df, lambda out: out

    def unpack(out: DataFrame) -> DataFrame:
        out = out.withColumn(_PACKED, F.transform(F.split(_PACKED, _SEP, -1), _from_cell))
        return out.select(*[F.get(_PACKED, F.lit(text.index(c))).alias(c) if c in text else _c(c) for c in order],
                          *[_c(c) for c in out.columns if c not in order and c != _PACKED])

    cells = F.array_join(F.transform(F.array(*[_c(c) for c in text]), _to_hex_cell), _SEP)
    packed = df.withColumn(_PACKED, F.concat_ws(_SEP, *[_to_cell(_c(c)) for c in text]))
    return packed.select(*[_c(c) for c in order if c not in text],
                         F.when(F.is_valid_utf8(_PACKED), F.col(_PACKED)).otherwise(cells).alias(_PACKED)), unpack


def dedup_packed(df: DataFrame) -> DataFrame:
    """``dedup`` with the text columns packed on the way: the same rows, about half the shuffle for rows of many short texts."""
    packed, unpack = pack_text(df)
    return unpack(dedup(packed))


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.na.drop(how="all")


def recode_columns(df: DataFrame, mappings: dict[str, dict]) -> DataFrame:
    """Value recodes per column in one projection (unmapped values pass through)."""
    return df.select(*[recode(F.col(c), mappings[c]).alias(c) if c in mappings else F.col(c)
                       for c in df.columns])


def sentinel_to_null(df: DataFrame, sentinels=("", '""""'), columns=None) -> DataFrame:
    """Turn sentinel strings into null in the given (default: every string) column, one select."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.select(*[F.when(F.col(c).isin(*sentinels), F.lit(None)).otherwise(F.col(c)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def coalesce_from(df: DataFrame, target: str, fallback: str) -> DataFrame:
    """target <- fallback where target is null."""
    return df.withColumn(target, F.coalesce(F.col(target), F.col(fallback)))


def first_non_missing(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """For each output column, the first non-null of its candidate columns (same row)."""
    return df.select(*[c for c in df.columns if c not in {x for v in groups.values() for x in v}],
                     *[F.coalesce(*[F.col(x) for x in xs]).alias(name) for name, xs in groups.items()])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
