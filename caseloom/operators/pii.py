"""Find, mask, fingerprint and drop personal data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom import fixed_values as fv
from caseloom.functions import parsing as p
from caseloom.operators.audit import text_leaves
from caseloom.operators.rules import code_counts

MASKS = ((fv.SSN_PATTERN, fv.SSN_MASK), (fv.PHONE_PATTERN, fv.PHONE_MASK))


def detect_pii(df: DataFrame, filled: dict[str, str], patterns: dict[str, tuple[str, str]]) -> DataFrame:
    """Add ``pii_types`` and ``pii_detected``.

    ``filled`` maps a type to a column that must be empty; ``patterns`` maps a
    type to (text column, regular expression).
    """
    hits = [(t, p.present(F.col(c))) for t, c in filled.items()]
    hits += [(t, F.coalesce(F.col(c), F.lit("")).rlike(rx)) for t, (c, rx) in patterns.items()]
    return df.withColumn("pii_types", p.codes_when(hits)).withColumn("pii_detected", F.size("pii_types") > 0)


def redact(df: DataFrame, col: str, out: str, masks: Sequence[tuple[str, str]] = MASKS) -> DataFrame:
    """Replace each pattern by its mask, in the order given; null text becomes empty."""
    text: Column = F.coalesce(F.col(col), F.lit(""))
    return df.withColumn(out, reduce(lambda t, m: F.regexp_replace(t, m[0], m[1]), masks, text))


def redact_leaves(
    df: DataFrame, masks: Sequence[tuple[str, str]] = MASKS, exempt: Sequence[str] = (), out: str = "redactions"
) -> DataFrame:
    """Every text of a table masked, however deep in structs, arrays and maps, and ``out``: how often, by path.

    A path is as ``audit.text_leaves`` names it; those in ``exempt``, and all
    below them, stay as they are. ``out`` maps each path with a mask to the
    number of masks there; a row without any has an empty map. Nulls stay null
    and other values as they are; a column that has the name ``out`` is
    replaced. Two keys of one map that are masked alike are
    told apart by their place in the map, so no entry is lost. One projection,
    no shuffle, however many leaves.
    """
    df, hits = df.drop(out), []

    def times(text: Column) -> Column:
        """How many masks the patterns, each after the one before it, put into a text; 0 for null."""
        found, left = F.lit(0), text
        for pattern, mask in masks:
            found, left = found + F.regexp_count(left, F.lit(pattern)), F.regexp_replace(left, pattern, mask)
        return F.coalesce(found, F.lit(0)).cast("long")

    def masked(text: Column) -> Column:
        return reduce(lambda t, m: F.regexp_replace(t, m[0], m[1]), masks, text)

    def keys(entries: Column, kind: T.DataType, path: str) -> Column:
        """Masked keys; a text key that changed has the place of its entry after it."""
        if not isinstance(kind, T.StringType) or path in exempt:
            return F.transform(entries, lambda e: rewrite(e["key"], kind, path))
        placed = lambda e, i: F.concat(masked(e["key"]), F.lit(" #"), i.cast("string"))
        return F.transform(entries, lambda e, i: F.when(masked(e["key"]) == e["key"], e["key"]).otherwise(placed(e, i)))

    def rewrite(c: Column, kind: T.DataType, path: str) -> Column:
        if path in exempt:
            return c
        if isinstance(kind, T.StringType):
            return masked(c)
        if isinstance(kind, T.StructType):
            inner = F.struct(*[rewrite(c[f.name], f.dataType, f"{path}.{f.name}").alias(f.name) for f in kind.fields])
            return F.when(c.isNotNull(), inner)
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: rewrite(x, kind.elementType, path))
        if isinstance(kind, T.MapType):
            entries = F.map_entries(c)
            values = F.transform(entries, lambda e: rewrite(e["value"], kind.valueType, f"{path}.value"))
            return F.map_from_arrays(keys(entries, kind.keyType, f"{path}.key"), values)
        return c

    for path, values in text_leaves(df):
        if not any(path == e or path.startswith(f"{e}.") for e in exempt):
            count = F.aggregate(F.coalesce(values, F.array()), F.lit(0).cast("long"), lambda n, x: n + times(x))
            hits.append(F.struct(F.lit(path).alias("path"), count.alias("n")))
    rewritten = [rewrite(F.col(f"`{f.name}`"), f.dataType, f.name).alias(f.name) for f in df.schema.fields]
    every = F.array(*hits) if hits else F.array().cast("array<struct<path:string,n:bigint>>")
    return df.select(*rewritten, F.map_from_entries(F.filter(every, lambda h: h["n"] > 0)).alias(out))


def redaction_summary(df: DataFrame, by: Sequence[str] = (), redactions: str = "redactions") -> DataFrame:
    """Rows and masks per path and group."""
    each = df.select(*by, F.explode(redactions).alias("path", "_n"))
    return each.groupBy(*by, "path").agg(F.count(F.lit(1)).alias("row_count"), F.sum("_n").alias("mask_count"))


def pii_hash(df: DataFrame, parts: Sequence[str], salt: str = "", out: str = "pii_hash") -> DataFrame:
    """SHA-256 of the parts joined by ``|``, only where personal data was found."""
    fields = [F.lit(salt)] if salt else []
    fields += [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in parts]
    return df.withColumn(out, F.when(F.col("pii_detected"), F.sha2(F.concat_ws("|", *fields), 256)))


def drop_sensitive(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def pii_summary(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per PII type and group."""
    return code_counts(df, "pii_types", by, name="pii_type")
