"""The audit log: canonical payloads, hash chains, merging, verification, registry differences, report lanes."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from .folds import ordered_fold

GENESIS = "0" * 64


def canonical_json(value) -> str:
    """Sorted keys, no spaces, ASCII, nulls kept, NaN refused."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=True, allow_nan=False)


def canonical(column: Column) -> Column:
    """A JSON text column in canonical form."""
    @F.pandas_udf("string")
    def each(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else canonical_json(json.loads(x)))

    return each(column)


def time_fields_ok(schema: StructType) -> list[str]:
    """Paths of fields that end in _ms without being integers."""
    bad: list[str] = []

    def walk(kind, path):
        if isinstance(kind, StructType):
            for f in kind.fields:
                here = f"{path}.{f.name}" if path else f.name
                if f.name.endswith("_ms") and not isinstance(f.dataType, (LongType, IntegerType)):
                    bad.append(here)
                walk(f.dataType, here)
        elif isinstance(kind, ArrayType):
            walk(kind.elementType, f"{path}[]")

    walk(schema, "")
    return bad


def merge_order(records: DataFrame, keys: list[str]) -> DataFrame:
    """Worker records in total order within each session: seq by file, start, operation and payload hash."""
    w = Window.partitionBy(*keys).orderBy("file_index", "start_ms", "operation", "payload_sha256")
    return records.withColumn("seq", F.row_number().over(w).cast("long") - 1)


def chain(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Link entries (seq, operation, payload_sha256) of each session: each hash covers the one before."""

    def step(previous, row):
        entry = hashlib.sha256(f"{row['seq']}|{row['operation']}|{row['payload_sha256']}|{previous}".encode()).hexdigest()
        return entry, ((row["seq"], previous, entry),)

    return ordered_fold(entries.select(*keys, "seq", "operation", "payload_sha256"), keys, ["seq"], lambda: GENESIS, step, "seq bigint, prev_sha256 string, entry_sha256 string")


def linked(entries: DataFrame, keys: list[str], order: list[str], heads: DataFrame | None = None, keep: list[str] | None = None) -> DataFrame:
    """Number and link entries (operation, payload_sha256) of each session in `order`, from its head (next_seq, prev_sha256) on; without one from the beginning.

    The result has the keys, seq, operation, payload_sha256, prev_sha256, entry_sha256 and the columns `keep`.
    """
    keep = keep or []
    columns = list(dict.fromkeys([*order, "operation", "payload_sha256", *keep]))
    rows = entries.select(*keys, *columns, F.lit(1).alias("__kind"), F.lit(None).cast("bigint").alias("__seq"), F.lit(None).cast("string").alias("__prev"))
    if heads is not None:
        empty = [F.lit(None).cast(entries.schema[c].dataType).alias(c) for c in columns]
        rows = rows.unionByName(heads.select(*keys, *empty, F.lit(0).alias("__kind"), F.col("next_seq").alias("__seq"), F.col("prev_sha256").alias("__prev")))

    def step(state, row):
        if not row["__kind"]:
            return (row["__seq"], row["__prev"]), ()
        seq, previous = state
        entry = hashlib.sha256(f"{seq}|{row['operation']}|{row['payload_sha256']}|{previous}".encode()).hexdigest()
        return (seq + 1, entry), ((seq, row["operation"], row["payload_sha256"], previous, entry, *(row[c] for c in keep)),)

    kept = "".join(f", `{c}` {entries.schema[c].dataType.simpleString()}" for c in keep)
    return ordered_fold(rows, keys, ["__kind", *order], lambda: (0, GENESIS), step, f"seq bigint, operation string, payload_sha256 string, prev_sha256 string, entry_sha256 string{kept}")


def verify(entries: DataFrame, keys: list[str], terminal: str | None = None) -> DataFrame:
    """Per session: entries, first bad seq (null: none) and whether the last entry is the terminal operation.

    Each entry is checked against its own hash and its predecessor's, so sessions verify in parallel.
    """
    w = Window.partitionBy(*keys).orderBy("seq")
    said = F.sha2(F.concat_ws("|", "seq", "operation", F.sha2("payload", 256), "prev_sha256"), 256)
    good = (F.col("entry_sha256") == said) & (F.col("prev_sha256") == F.coalesce(F.lag("entry_sha256").over(w), F.lit(GENESIS))) & (F.col("seq") == F.row_number().over(w) - 1)
    checked = entries.withColumn("__ok", F.coalesce(good, F.lit(False)))
    last = F.max_by("operation", "seq") == terminal if terminal else F.lit(True)
    return checked.groupBy(*keys).agg(F.count("*").alias("entries"), F.min(F.when(~F.col("__ok"), F.col("seq"))).alias("first_bad"), last.alias("complete"))


def registry_difference(expected: DataFrame, actual: DataFrame, path: str = "path", digest: str = "sha256") -> DataFrame:
    """(path, kind): missing, unexpected or mismatched."""
    both = expected.select(path, F.col(digest).alias("__e")).join(actual.select(path, F.col(digest).alias("__a")), path, "full")
    kind = F.when(F.col("__a").isNull(), "missing").when(F.col("__e").isNull(), "unexpected").when(F.col("__e") != F.col("__a"), "mismatched")
    return both.select(path, kind.alias("kind")).where("kind is not null")


WRAPPER = ("file_index", "operation", "payload", "start_ms")


def unwrap(entries: DataFrame) -> DataFrame:
    """Worker records nested in a merged entry give their own payload, file_index and start_ms; others pass through."""
    keys = F.array_sort(F.json_object_keys("payload"))
    inner = F.get_json_object("payload", "$.payload")
    nested = (keys == F.array(*map(F.lit, WRAPPER))) & (F.get_json_object("payload", "$.operation") == F.col("operation")) & inner.startswith("{")
    nested = F.coalesce(nested, F.lit(False))
    number = lambda k: F.when(nested, F.get_json_object("payload", f"$.{k}").cast("long"))
    return entries.withColumns({"file_index": number("file_index"), "start_ms": number("start_ms"), "payload": F.when(nested, inner).otherwise(F.col("payload"))})


def verdict(tier: Column, target: Column, other: Column, margin_failed: Column, high: float, med: float, margin: float, floor: float) -> Column:
    """A sentence for a block's tier."""
    f = lambda c, places=3: F.when(c.isNull(), "-").otherwise(F.format_string(f"%.{places}f", c))
    t, h, m = f(target), f"{high:.3f}", f"{med:.3f}"
    gap = f(target - other)
    return (
        F.when((tier == "SKIPPED") | target.isNull(), "SKIPPED: no scored window covers this block")
        .when((tier == "HIGH") & other.isNull(), F.concat(F.lit("HIGH: target "), t, F.lit(f" > {h}; no other profile")))
        .when(tier == "HIGH", F.concat(F.lit("HIGH: target "), t, F.lit(f" > {h} and margin "), gap, F.lit(f" > {margin:.2f}")))
        .when((tier == "MEDIUM") & margin_failed, F.concat(F.lit("MEDIUM: target "), t, F.lit(f" > {h} but margin "), gap, F.lit(f" <= {margin:.2f}")))
        .when(tier == "MEDIUM", F.concat(F.lit(f"MEDIUM: {m} < target "), t, F.lit(f" <= {h}")))
        .when(tier == "SUB", F.concat(F.lit(f"SUB: {floor:.2f} <= target "), t, F.lit(f" <= {m}")))
        .otherwise(F.concat(F.lit("REJECT: target "), t, F.lit(f" < {floor:.2f}")))
    )


def lanes(records: DataFrame, files: DataFrame) -> DataFrame:
    """Records (file_index, operation, start_ms, end_ms) on the global clock; a file that isn't known has offset 0."""
    at = records.join(files.select("file_index", "file_offset_ms"), "file_index", "left").withColumn("__o", F.coalesce("file_offset_ms", F.lit(0)))
    return at.withColumns({"global_start_ms": F.col("start_ms") + F.col("__o"), "global_end_ms": F.col("end_ms") + F.col("__o")}).drop("__o", "file_offset_ms")
