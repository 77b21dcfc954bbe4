"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every historical version of a text is a blob, addressed by its SHA-256.  A ledger table holds one row
for each (blob, rule version) scanned so far.  A scan takes the blobs that the ledger lacks for the
current rules, one text a blob, finds all spans, appends to the ledger, and joins the ledger's
findings back to every path that ever held the blob.

Spans come from the built-in regular expressions: the pieces between matches (split) and the matches
(regexp_extract_all) alternate, so a running sum of their lengths gives code point offsets.  A null
text is the empty blob.  Repeated rows and copies share a blob, are scanned once and all reported.  Other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import scratch

RULE_VERSION = "2"
# The three base rules (letters of a keyword in either case), then added ones.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
RULES = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "pem": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "forge": r"gh[pousr]_[A-Za-z0-9]{36}",
}
BASE = ("assign", "access", "hex")
LEDGER = "blob string, rule_version string, n_assign bigint, n_access bigint, n_hex bigint, base_spans string, spans string"


def _matches(order: int, kind: str) -> Column:
    """For each match: the rule's number, the match's number, lengths of the gap before it and of itself, and whether it stays."""
    found, gaps = F.col(f"m_{kind}"), F.split("text", RULES[kind], -1)
    stays = lambda m: F.length(F.regexp_extract(m, RULES[kind], 2)) >= 6 if kind == "assign" else F.lit(True)
    each = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(F.length(g).cast("long").alias("gap"), F.length(m).cast("long").alias("len"), stays(m).alias("stays")))
    numbered = F.transform(each, lambda x, i: F.struct(F.lit(order).alias("rule"), i.alias("i"), x["gap"].alias("gap"), x["len"].alias("len"), x["stays"].alias("stays")))
    return F.when(F.size(found) > 0, numbered)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda x: x["said"]), ",")


def scan_blobs(blobs: DataFrame) -> DataFrame:
    """Scan (blob, text) rows; returns the ledger's columns, one row a blob."""
    kinds = list(RULES)
    found = blobs.select("blob", "text", *(F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in RULES.items()))
    empty = F.array().cast("array<struct<rule:int,i:int,gap:bigint,len:bigint,stays:boolean>>")
    lists = found.select("blob", F.concat(*(F.coalesce(_matches(i, k), empty) for i, k in enumerate(kinds))).alias("all"))
    rows = lists.select("blob", F.explode_outer("all").alias("x")).select("blob", "x.*")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(Window.partitionBy("blob", "rule").orderBy("i")))
    name = F.element_at(F.array(*map(F.lit, kinds)), F.coalesce(F.col("rule"), F.lit(0)) + 1)
    start = F.col("end") - F.col("len")
    span = F.struct(start.alias("start"), F.col("rule"), F.concat_ws(":", name, start, "end").alias("said"))
    base = F.col("rule") < len(BASE)
    count = lambda i: F.count(F.when(F.col("stays") & (F.col("rule") == i), 1))
    return rows.groupBy("blob").agg(
        F.lit(RULE_VERSION).alias("rule_version"),
        *(count(i).alias(f"n_{k}") for i, k in enumerate(BASE)),
        _joined(F.collect_list(F.when(F.col("stays") & base, span))).alias("base_spans"),
        _joined(F.collect_list(F.when(F.col("stays"), span))).alias("spans"),
    )


def update_ledger(versions: DataFrame, ledger: str) -> DataFrame:
    """Scan the blobs of (text) that the ledger at this path lacks, append them, and return its rows for the current rules."""
    spark: SparkSession = versions.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    exists = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    text = F.coalesce(F.col("text"), F.lit(""))
    blobs = versions.select(text.alias("text")).groupBy(F.sha2("text", 256).alias("blob")).agg(F.first("text").alias("text"))
    if exists:
        seen = spark.read.schema(LEDGER).parquet(ledger).where(F.col("rule_version") == RULE_VERSION).select("blob").distinct()
        blobs = blobs.join(seen, "blob", "left_anti")
    scan_blobs(blobs).write.mode("append").parquet(ledger)
    # two writers may have appended one blob; its findings are the same
    return spark.read.schema(LEDGER).parquet(ledger).where(F.col("rule_version") == RULE_VERSION).dropDuplicates(["blob"])


def scan(versions: DataFrame, ledger: str | None = None) -> DataFrame:
    """Per row of versions: doc_id, blob, n_assign, n_access, n_hex, base_spans and spans (kind:start:end, by start)."""
    found = update_ledger(versions, ledger or scratch(versions.sparkSession, "ledger")).where("spans <> ''").drop("rule_version")
    rows = versions.select("doc_id", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("blob")).join(found, "blob", "left")
    zero = {"n_assign": 0, "n_access": 0, "n_hex": 0, "base_spans": "", "spans": ""}
    return rows.select("doc_id", "blob", *(F.coalesce(F.col(k), F.lit(v).cast("long") if v == 0 else F.lit(v)).alias(k) for k, v in zero.items()))
