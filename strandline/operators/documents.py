"""Layer and batch documents: one canonical document a file, and a tree of hashes over them in place of one document of all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..sources.shared import stored


def sorted_fields(df: DataFrame) -> DataFrame:
    """df with its columns, and the fields of structs in them, in order of name."""

    def column(c, kind):
        if isinstance(kind, StructType):
            return F.when(c.isNotNull(), F.struct(*(column(c[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name))))
        if isinstance(kind, ArrayType) and isinstance(kind.elementType, (StructType, ArrayType)):
            return F.transform(c, lambda x: column(x, kind.elementType))
        return c

    return df.select(*(column(F.col(c), df.schema[c].dataType).alias(c) for c in sorted(df.columns)))


def file_documents(files: DataFrame, parts: dict[str, DataFrame], key: str = "file_index", order: str = "start_ms") -> DataFrame:
    """(key, document, sha256): each file's columns, and as arrays in `order` its rows of each part, as JSON with sorted keys, no spaces and nulls kept.

    Values are integers, booleans, plain ASCII text and nulls, as in all timed payloads; a file gathers its own rows only.
    """
    out = files
    for name, df in parts.items():
        own = sorted_fields(df.drop(key)).columns
        rows = sorted_fields(df).groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("__at"), F.to_json(F.struct(*own), {"ignoreNullFields": "false"}).alias("__j"), F.struct(*own).alias("__v")))).alias("__rows"))
        out = out.join(rows, key, "left").withColumn(name, F.coalesce(F.transform("__rows", lambda r: r["__v"]), F.array())).drop("__rows")
    text = F.to_json(F.struct(*sorted_fields(out).columns), {"ignoreNullFields": "false"})
    return out.select(key, text.alias("document")).withColumn("sha256", F.sha2("document", 256))


def digest_tree(digests: DataFrame, position: str = "file_index", digest: str = "sha256", fanout: int = 1024, levels: int | None = None) -> DataFrame:
    """(level, position, children, sha256): a node hashes the digests of up to `fanout` neighbours in order, up to one root, or to the roots that `levels` levels make.

    A change of one file changes the nodes above it alone, and no task gathers more than `fanout` digests, so a batch has a hash of all its files without a row that holds
    them.  The result depends on positions and digests only.  Positions are integers from 0; an empty table has no root.
    """
    level = digests.select(F.lit(0).alias("level"), F.col(position).cast("bigint").alias("position"), F.lit(0).cast("bigint").alias("children"), F.col(digest).alias("sha256"))
    every, top = [level], digests.agg(F.max(F.col(position).cast("bigint"))).first()[0]
    if top is None:
        return level
    n = 0
    while (top > 0 or n == 0) and n != levels:
        n, top = n + 1, top // fanout
        up = every[-1].groupBy(F.expr(f"position div {fanout}").alias("position")).agg(F.count("*").alias("children"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "sha256"))), lambda c: c["sha256"]), ""), 256).alias("sha256"))
        every.append(stored(up.select(F.lit(n).alias("level"), "position", "children", "sha256"), "digests"))
    out = every[1]
    for df in every[2:]:
        out = out.unionByName(df)
    return out
